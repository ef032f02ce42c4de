"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule rejects a document whose score is above a cutoff. Cutoffs are not guessed: they form one fixed
ladder, which tightens a rule from its loosest cutoff to its strictest, then the next rule, and so on. On
the labelled documents of each stratum (language) every step of the ladder is tested against the hypothesis
"all cutoffs so far together reject more than ``risk`` of the good documents". The test is the exact
binomial tail P(Bin(n, risk) <= rejected). Steps of a stratum are tested in their order (fixed-sequence
testing, which needs no correction among them); the strata share ``error`` by Holm's correction, a stratum
whose whole ladder passes handing its share to the others. So with probability ``1 - error`` no passing
step of any stratum rejects more than ``risk`` of its good documents. As that holds for all passing
steps at once, the one used may be chosen freely: it catches most labelled bad documents less the good ones
it loses, the strictest of equals. A stratum with too few labels for any step gets no cutoff: with
four strata a step takes at least 217 good documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, read_table, unused, written

BLANKS = " \t\n\x0b\f\r"
REPEAT = 8
MIN_WORDS = 20
RISK = 0.02
ERROR = 0.05
#: Cutoffs of each rule, strictest first. Rules stand in the order of the ladder: first those whose high
#: scores natural text hardly has, then repeats, which lists, forms and verse have too.
GRID = {
    "symbols": (0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3),
    "long_words": (8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0),
    "capitals": (0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7),
    "dup_lines": (0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7),
    "repeats": (0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3),
}
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def _repeated_words(words: Column, starts: Column, size: int) -> Column:
    """Words covered by windows that occur at least twice in ``words``; windows are compared exactly."""
    def covered(runs: Column) -> Column:
        again = F.filter(runs, lambda r, i: (F.get(runs, i - 1)["w"].eqNullSafe(r["w"])) | (F.get(runs, i + 1)["w"].eqNullSafe(r["w"])))
        at = F.sort_array(F.transform(again, lambda r: r["i"]))
        none = F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last"))
        return F.aggregate(at, none, lambda a, i: F.struct((a["n"] + F.least(F.lit(size), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])

    runs = F.sort_array(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i, size), " ").alias("w"), i.alias("i"))))
    return _bound(runs, covered)


def with_features(docs: DataFrame, prefix: str = "", size: int = REPEAT) -> DataFrame:
    """``docs`` and the counts of FEATURES, each named with ``prefix``; no shuffle, whole texts.

    Windows are hashed first; only texts in which a hash repeats compare their windows as text.
    """
    t = f"{prefix}_text"
    kept = docs.columns
    df = docs.withColumn(t, F.coalesce("text", F.lit("")))
    df = df.withColumn(f"{prefix}_trimmed", F.btrim(t, F.lit(BLANKS)))
    trimmed = F.col(f"{prefix}_trimmed")
    df = df.withColumn(f"{prefix}_words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACES}+", -1)))
    words = F.col(f"{prefix}_words")
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - (size - 1))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(f"{prefix}_starts", starts)
    starts = F.col(f"{prefix}_starts")
    df = df.withColumn(f"{prefix}_hashes", F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, size))))
    hashes = F.col(f"{prefix}_hashes")
    df = df.withColumn(f"{prefix}_lines", F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    lines = F.col(f"{prefix}_lines")
    chars = {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(t, F.lit(f"{SPACES}+"), F.lit(""))),
        "n_symbols": F.length(F.regexp_replace(t, F.lit(r"[^#*$%&|<>]+"), F.lit(""))),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_repeated_words(words, starts, size)),
        "n_lines": F.size(lines),
        "n_capitals": F.length(F.regexp_replace(t, F.lit(r"\P{Lu}+"), F.lit(""))),
    }
    return df.select(*[F.col(f"`{c}`") for c in kept], *[chars[n].cast("long").alias(f"{prefix}{n}") for n in FEATURES])


def scores(prefix: str = "") -> dict[str, Column]:
    """The score of each rule; higher is worse."""
    n = {name: F.col(f"{prefix}{name}") for name in FEATURES}
    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))
    return {
        "symbols": share(n["n_symbols"], n["word_chars"]),
        "dup_lines": share(n["n_dup_lines"], n["n_lines"]),
        "repeats": share(n["n_repeat_words"], n["n_words"]),
        "capitals": share(n["n_capitals"], n["word_chars"]),
        "long_words": share(n["word_chars"], n["n_words"]),
    }


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exactly summed in logarithms; 1 where k is at least n * p (never below 0.25 there)."""
    step = F.log(F.lit(p / (1 - p)))
    first = n * F.log(F.lit(1 - p))
    start = F.struct(first.alias("t"), F.exp(first).alias("sum"))
    def add(a: Column, i: Column) -> Column:
        t = a["t"] + F.log((n - i + 1) / i) + step
        return F.struct(t.alias("t"), (a["sum"] + F.exp(t)).alias("sum"))
    upto = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.aggregate(upto, start, add, lambda a: a["sum"])))


def ladder(grid: dict = GRID) -> list[tuple[str, float]]:
    """The steps: (rule, cutoff), loosest first within a rule. A step keeps the cutoffs of all steps before it."""
    return [(rule, cut) for rule, cuts in grid.items() for cut in sorted(cuts, reverse=True)]


def first_step(rules: dict[str, Column], grid: dict = GRID) -> Column:
    """Number of the first step that rejects a document with these scores; the number of steps if none does."""
    steps = ladder(grid)
    hits = [F.when(rules[rule] > cut, F.lit(i)) for i, (rule, cut) in enumerate(steps)]
    return F.coalesce(*hits, F.lit(len(steps)))


def step_tests(labelled: DataFrame, risk: float = RISK, error: float = ERROR, steps: int = len(ladder())) -> DataFrame:
    """Every step with its evidence: stratum, step, n, rejected, caught, p_value, passes.

    ``labelled``: a row a labelled document with ``stratum``, ``good`` (boolean) and ``first``, the first step
    that rejects it (``steps`` or more if none does). ``n`` counts the good documents, ``rejected`` and
    ``caught`` the good and the bad ones that a step rejects.
    """
    cells = labelled.groupBy("stratum", "first").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    strata = cells.groupBy("stratum").agg(F.sum("good").alias("n"), F.collect_list(F.struct("first", "good", "bad")).alias("by"))
    rows = strata.where("n > 0").select("stratum", "n", "by", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"))

    def upto(name: str) -> Column:
        return F.aggregate(F.filter("by", lambda b: b["first"] <= F.col("step")), F.lit(0).cast("long"), lambda a, b: a + b[name])

    rows = rows.select("stratum", "step", "n", upto("good").alias("rejected"), upto("bad").alias("caught"))
    rows = rows.withColumn("p_value", binomial_tail(F.col("n"), F.col("rejected"), risk))
    # Later steps reject no fewer documents, so p-values rise along a ladder and the last one is its largest.
    rows = rows.withColumn("largest", F.max("p_value").over(Window.partitionBy("stratum")))
    by_largest, whole = Window.orderBy("largest", "stratum"), Window.partitionBy()  # a stratum has ``steps`` rows
    rows = rows.withColumn("turn", F.dense_rank().over(by_largest))
    rows = rows.withColumn("strata", F.max("turn").over(whole))
    rows = rows.withColumn("stopped", F.min(F.when(F.col("largest") * (F.col("strata") - F.col("turn") + 1) > error, F.col("turn"))).over(whole))
    share = error / (F.col("strata") - F.least("turn", "stopped") + 1)
    return rows.select("stratum", "step", "n", "rejected", "caught", "p_value", (F.col("p_value") <= share).alias("passes"))


def chosen_steps(tests: DataFrame) -> DataFrame:
    """``stratum`` and ``step``: of its passing steps the one that catches most bad documents less the good ones it loses."""
    return tests.where("passes").groupBy("stratum").agg(F.max_by("step", F.struct(F.col("caught") - F.col("rejected"), F.col("step"))).alias("step"))


def judged(featured: DataFrame, labels: DataFrame, prefix: str = "", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``featured`` (written, with ``doc_id`` and ``lang``) plus ``{prefix}base_failed`` and ``{prefix}kept``.

    ``labels`` has ``doc_id`` and ``quality``; a document is good if its best label is 1, bad if that is 0, and
    counts once however many rows it has. Good documents that the base rule rejects are not lost to a step.
    Rows with a null ``doc_id`` are never labelled. The stratum of a null ``lang`` is its own.
    """
    none = len(ladder())
    stratum = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col("lang").cast("string")))
    best = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("best")).where("best in (0, 1)")
    bad_base = (F.col(f"{prefix}n_words") < MIN_WORDS) | (100 * F.col(f"{prefix}n_repeat_words") > 30 * F.col(f"{prefix}n_words"))
    first = first_step(scores(prefix))
    scored = featured.select("doc_id", stratum.alias("stratum"), F.when(bad_base, F.lit(none)).otherwise(first).alias("first"))
    labelled = scored.join(best, "doc_id").groupBy("doc_id", "stratum").agg(F.min("first").alias("first"), (F.first("best") == 1).alias("good"))
    key, step = unused(featured.columns, "_stratum"), unused(featured.columns, "_step")
    found = written(chosen_steps(step_tests(labelled, risk, error)), "steps").select(F.col("stratum").alias(key), F.col("step").alias(step))
    over = F.coalesce(first <= F.col(step), F.lit(False))
    return (featured.withColumn(key, stratum).join(found, key, "left")
            .withColumns({f"{prefix}base_failed": bad_base, f"{prefix}kept": ~bad_base & ~over}).drop(key, step))


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Counts, base rule and verdict of every document.

    Needs ``doc_id``, ``text`` and ``lang``; other columns are ignored. One row a row: ``doc_id``,
    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``kept``. Null and blank texts have no words and fail the base rule. Repeated rows stay. Without
    labels only the base rule rejects. An empty table gives no rows. A very long text is one value in its task.
    """
    featured = written(with_features(docs.select("doc_id", "lang", "text")).drop("text"), "features")
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged(featured, labels, "", risk, error).select("doc_id", *shown)


def good_documents(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``docs`` without the rejected rows; texts are read once and never shuffled on a key.

    Columns of any name may be there; the counts take names that none of them begins with.
    """
    prefix = "_q_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    featured = written(with_features(docs, prefix), "featured")
    return judged(featured, labels, prefix, risk, error).where(f"{prefix}kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Quality counts and verdicts of all documents."""
    return quality_rules(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
