"""Language identification by interpolated Kneser-Ney character models.

Spark counts the character n-grams of every training document per language. From these counts one
model per language is built: absolute discounting of the highest order, continuation counts (in how
many contexts an n-gram follows) below it, and interpolation down to a uniform letter. Discounts and
continuation counts are Spark aggregates over all n-grams; none is left out. The models share one
sorted array of n-gram hashes per order with a column of log probabilities per language, so a text
position takes one binary search for all languages; n-grams that no language has are backed off
position by position.

The model travels in blocks of bounded size. A block has some languages and, above single characters,
the n-grams with some characters before the last one. All n-grams and contexts that a text position
looks up have the same character there, so each position is scored by one block of each language.

A text gets the language with the lowest cross-entropy per character. Two numbers are calibrated on
training documents that the calibrated model has not seen: how sharply entropy gaps turn into a
probability, and below which probability a prediction is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, blocks, read_table, written
from .wordblocks import BASE, mixed, powers, run_hashes

ORDER = 4
BLOCK_GRAMS = 1_000_000  # (language, n-gram) pairs of a block of the model
BLOCK_CELLS = 8_000_000  # at most so many n-grams times languages of a block: some 100 MB
BLOCK_LANGUAGES = 16
TEXT_BYTES = 64 << 20  # text that is scored while one of several blocks is held
PIECE = 1 << 20
SHARPNESS = tuple(float(2**k) for k in range(0, 9))
THRESHOLDS = tuple(k / 20 for k in range(0, 20))
MAX_ERROR = 0.01
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def characters(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised code points of some texts, where each text starts in them, its number of letters.

    Lower case; runs of other characters become one space; ``order - 1`` zeros precede each text.
    """
    pad = bytes(4 * (order - 1))
    parts = [t.replace("\0", " ").lower().encode("utf-32-le", "surrogatepass") for t in texts]
    codes = np.frombuffer(b"".join(x for p in parts for x in (pad, p)), np.uint32)
    starts = np.cumsum([0, *(len(p) // 4 + order - 1 for p in parts)])
    letter = letters()[codes]
    keep = letter | (codes == 0)
    keep[1:] |= letter[:-1]
    kept = np.concatenate([[0], np.cumsum(keep)])
    found = np.concatenate([[0], np.cumsum(letter)])
    out = np.where(letter | (codes == 0), codes, 0x20)[keep]
    return out, kept[starts], np.diff(found[starts])


def pieces(texts: list[str | None], limit: int = PIECE) -> Iterator[tuple[list[int], list[str]]]:
    """(text numbers, pieces) of about ``limit`` characters together; longer texts are cut, none is dropped."""
    owner, held, size = [], [], 0
    for j, t in enumerate(texts):
        t = t or ""
        for i in range(0, max(len(t), 1), limit):
            piece = t[i:i + limit]
            if held and size + len(piece) > limit:
                yield owner, held
                owner, held, size = [], [], 0
            owner.append(j)
            held.append(piece)
            size += len(piece)
    if held:
        yield owner, held


def gram_counts(texts: list[str], order: int = ORDER) -> tuple[list[str], list[int]]:
    """The n-grams of the texts (as strings of ``order`` code points) and how often they occur."""
    counts: dict[str, int] = {}
    for _, part in pieces(texts):
        codes, _, _ = characters(part, order)
        present = np.zeros(0x110000, bool)
        present[codes] = True
        alphabet = np.flatnonzero(present).astype(np.uint32)
        number = np.zeros(0x110000, np.uint64)
        number[alphabet] = np.arange(len(alphabet), dtype=np.uint64)
        small, width = number[codes], max(1, int(len(alphabet)).bit_length())
        whole, size = codes[order - 1:] != 0, len(codes) - order + 1
        if width * order <= 64:
            key = np.zeros(size, np.uint64)
            for k in range(order):
                key = (key << np.uint64(width)) | small[k:size + k]
        else:  # too many letters for one key: number the grams anew with every letter
            key = np.zeros(size, np.int64)
            for k in range(order):
                key = np.unique(key * np.int64(len(alphabet)) + small[k:size + k].astype(np.int64), return_inverse=True)[1]
        _, at, n = np.unique(key[whole], return_index=True, return_counts=True)
        grams = codes[np.flatnonzero(whole)[at][:, None] + np.arange(order)]
        flat = grams.tobytes().decode("utf-32-le", "surrogatepass")
        for i, c in enumerate(n.tolist()):
            gram = flat[order * i:order * (i + 1)]
            counts[gram] = counts.get(gram, 0) + c
    return list(counts), list(counts.values())


def hash_rows(grams: np.ndarray) -> np.ndarray:
    """The hash that ``run_hashes`` gives these code points (a gram a row) within a text."""
    return mixed(((grams.astype(np.uint64) + np.uint64(1)) * powers(BASE, grams.shape[1])).sum(axis=1, dtype=np.uint64))


def discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and once + 2 * twice else 0.5


def code_points(grams: list[str], k: int) -> np.ndarray:
    """Code points of grams of ``k`` characters, a gram a row."""
    return np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, k)


class KneserNey:
    """Models of some languages over shared sorted hash arrays.

    ``counts`` has for each order the n-grams (a row of code points each) and counts of each language.
    Where ``middles`` is given, only the n-grams with such a character before the last one are there,
    and only positions with such a character before them are scored.
    """

    def __init__(self, table: dict[str, tuple[list[str], np.ndarray]], order: int = ORDER):
        counts = {order: {lang: (code_points(grams, order), np.asarray(n, np.float64)) for lang, (grams, n) in table.items()}}
        for k in range(order - 1, 0, -1):  # in how many contexts: the distinct (k + 1)-grams that end in it
            found = {lang: np.unique(codes[:, 1:], axis=0, return_counts=True) for lang, (codes, _) in counts[k + 1].items()}
            counts[k] = {lang: (codes, n.astype(np.float64)) for lang, (codes, n) in found.items()}
        discounts = {(lang, k): discount((n == 1).sum(), (n == 2).sum()) for k, found in counts.items() for lang, (_, n) in found.items()}
        alphabet = len(np.unique(np.concatenate([c for c, _ in counts[1].values()]))) if table else 0
        self._build(sorted(table), counts, discounts, alphabet, order)

    @classmethod
    def block(cls, languages: list[str], counts: dict, discounts: dict, alphabet: int, order: int, middles: np.ndarray | None) -> KneserNey:
        """A part of a larger model; ``discounts`` and ``alphabet`` are those of the whole."""
        self = cls.__new__(cls)
        self._build(languages, counts, discounts, alphabet, order, middles)
        return self

    def _build(self, languages: list[str], counts: dict, discounts: dict, alphabet: int, order: int, middles: np.ndarray | None = None) -> None:
        self.order, self.languages, self.middles = order, languages, middles
        self.floor = -np.log(alphabet + 1.0)  # a character that no language has
        self.keys, self.logs, self.heads, self.shares = [], [], [], []
        for k in range(1, order + 1):
            self._add_order(k, counts[k], discounts)

    def _add_order(self, k: int, found: dict, discounts: dict) -> None:
        union = np.unique(np.concatenate([g for g, _ in found.values()]), axis=0) if found else np.zeros((0, k), np.uint32)
        key = hash_rows(union)
        by = np.argsort(key)
        union, key = union[by], key[by]
        head = hash_rows(union[:, :-1]) if k > 1 else np.zeros(len(union), np.uint64)
        heads, at_head = np.unique(head, return_inverse=True)
        lower = np.exp(self._lookup(k - 1, hash_rows(union[:, 1:]))) if k > 1 else np.full((len(union), len(self.languages)), np.exp(self.floor))
        probability, share = np.empty((len(union), len(self.languages))), np.ones((len(heads), len(self.languages)))
        for c, lang in enumerate(self.languages):
            n = np.zeros(len(union))
            if lang in found:
                grams, counts = found[lang]
                n[np.searchsorted(key, hash_rows(grams))] = counts
            less = discounts[lang, k]
            total = np.bincount(at_head, n, len(heads))
            kinds = np.bincount(at_head, n > 0, len(heads))
            seen = total > 0
            share[seen, c] = less * kinds[seen] / total[seen]
            own = np.maximum(n - less, 0) / np.maximum(total, 1)[at_head]
            probability[:, c] = own + share[at_head, c] * lower[:, c]
        self.keys.append(key)
        self.logs.append(np.log(probability).astype(np.float32))
        self.heads.append(heads)
        self.shares.append(np.log(share).astype(np.float32))

    def _lookup(self, k: int, key: np.ndarray) -> np.ndarray:
        """Log probabilities of k-grams that all are in the table."""
        return self.logs[k - 1][np.searchsorted(self.keys[k - 1], key)].astype(np.float64)

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """A row for each code point from the ``order``-th on, a column a language; 0 where another block scores."""
        n = len(codes) - self.order + 1
        out = np.zeros((n, len(self.languages)), np.float32)
        todo = np.arange(n) if self.middles is None else np.flatnonzero(self.middles[codes[self.order - 2:-1]])
        extra = np.zeros((n, len(self.languages)), np.float32)
        values = codes.astype(np.uint64)
        for k in range(self.order, 0, -1):
            # grams of k characters that end where the order-long one ends
            key = run_hashes(values, k)[self.order - k:][todo]
            at = np.minimum(np.searchsorted(self.keys[k - 1], key), max(0, len(self.keys[k - 1]) - 1))
            hit = self.keys[k - 1][at] == key if len(self.keys[k - 1]) else np.zeros(len(key), bool)
            out[todo[hit]] = self.logs[k - 1][at[hit]] + extra[todo[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            head = run_hashes(values, k - 1)[self.order - k:][todo] if k > 1 else np.zeros(len(todo), np.uint64)
            at = np.minimum(np.searchsorted(self.heads[k - 1], head), max(0, len(self.heads[k - 1]) - 1))
            hit = self.heads[k - 1][at] == head if len(self.heads[k - 1]) else np.zeros(len(head), bool)
            extra[todo[hit]] += self.shares[k - 1][at[hit]]
        out[todo] = self.floor + extra[todo]
        return out

    def sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum of log probabilities of each text in each language, its characters and its letters."""
        total, length = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        n_letters = np.zeros(len(texts), np.int64)
        for owner, part in pieces(texts):
            codes, starts, found = characters(part, self.order)
            np.add.at(n_letters, owner, found)
            scored = self.log_probabilities(codes)
            scored[codes[self.order - 1:] == 0] = 0
            sums = np.concatenate([np.zeros((1, scored.shape[1])), np.cumsum(scored, axis=0, dtype=np.float64)])
            stops = starts[1:] - (self.order - 1)
            begins = starts[:-1]
            np.add.at(total, owner, sums[np.maximum(stops, begins)] - sums[begins])
            np.add.at(length, owner, np.maximum(stops - begins, 0))
        return total, length, n_letters

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy a character (nats) of each text in each language, and its number of letters."""
        total, length, n_letters = self.sums(texts)
        return -total / np.maximum(length, 1)[:, None], n_letters


class Models:
    """The models of all languages in broadcast blocks; a worker holds one block at a time."""

    def __init__(self, languages: list[str], parts: list[tuple[int, Broadcast]]):
        self.languages, self.parts = languages, parts
        self.text_bytes = TEXT_BYTES if len(parts) > 1 else BLOCK_BYTES

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """As ``KneserNey.entropies``; there is at least one language."""
        total = np.zeros((len(texts), len(self.languages)))
        for first, held in self.parts:
            model = held.value
            part, length, n_letters = model.sums(texts)
            total[:, first:first + part.shape[1]] += part
            if len(self.parts) > 1:
                del model
                held.__dict__.pop("_value", None)  # read from the local file again when it is needed
        return -total / np.maximum(length, 1)[:, None], n_letters


def posterior(entropies: np.ndarray, sharpness: float) -> np.ndarray:
    scaled = np.exp(-sharpness * (entropies - entropies.min(axis=1, keepdims=True)))
    return scaled / scaled.sum(axis=1, keepdims=True)


def training_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang``, ``part``, ``gram``, ``n`` over all rows of ``docs`` (``lang``, ``part``, ``text``); merged before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 4 << 20):
            groups: dict[tuple, list] = {}
            for lang, part, text in zip(*(block.column(c).to_pylist() for c in ("lang", "part", "text"))):
                groups.setdefault((lang, part), []).append(text)
            for (lang, part), texts in groups.items():
                grams, n = gram_counts(texts, order)
                yield pa.record_batch([pa.array([lang] * len(n), pa.string()), pa.array([part] * len(n), pa.int32()), pa.array(grams, pa.string()), pa.array(n, pa.int64())], ["lang", "part", "gram", "n"])

    counted = docs.select("lang", "part", "text").mapInArrow(run, "lang string, part int, gram string, n long")
    return counted.groupBy("lang", "part", "gram").agg(F.sum("n").alias("n"))


def gram_tables(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang``, ``k``, ``gram``, ``n`` of every order, and ``middle``: the character before the last.

    ``n`` counts occurrences in the highest order and contexts, which are distinct longer n-grams, below.
    """
    level = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    out = level.withColumn("k", F.lit(order))
    for k in range(order - 1, 0, -1):
        level = level.groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n"))
        out = out.unionByName(level.withColumn("k", F.lit(k)))
    middle = F.when(F.col("k") > 1, F.ascii(F.expr("substring(gram, k - 1, 1)"))).otherwise(-1)
    return out.select("lang", "k", "gram", "n", middle.alias("middle"))


def model_of(counts: DataFrame, order: int = ORDER, block_grams: int = BLOCK_GRAMS, block_cells: int = BLOCK_CELLS, block_languages: int = BLOCK_LANGUAGES) -> Models:
    """The models from ``lang``, ``gram``, ``n``, with all n-grams.

    A block is as large as the bounds allow; the n-grams of one character before the last, in the
    languages of a block, stay together.
    """
    spark = counts.sparkSession
    tables = written(gram_tables(counts, order), "orders")
    stats = tables.groupBy("lang", "k").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()
    if not stats:
        return Models([], [])
    discounts = {(r.lang, r.k): discount(r.once, r.twice) for r in stats}
    languages = sorted({r.lang for r in stats})
    alphabet = tables.where("k = 1").agg(F.count_distinct("gram")).first()[0]
    team = {lang: i // block_languages for i, lang in enumerate(languages)}
    tables = tables.join(F.broadcast(spark.createDataFrame(list(team.items()), "lang string, team int")), "lang")
    sizes: dict[int, list] = {}
    for r in tables.where("k > 1").groupBy("team", "middle").agg(F.count("*").alias("rows")).collect():
        sizes.setdefault(r.team, []).append((r.middle, r.rows))

    plan, place = [], []  # (team, its characters before the last) of each block; where a character's n-grams go
    for g in range(max(team.values()) + 1):
        members = languages[g * block_languages:(g + 1) * block_languages]
        limit, held = min(block_grams, block_cells // len(members)), None
        for middle, rows in sorted(sizes[g]):
            if held is None or held + rows > limit:
                plan.append((g, members, []))
                held = 0
            held += rows
            plan[-1][2].append(middle)
            place.append((g, middle, len(plan) - 1))
    if len(plan) > 1:
        where = spark.createDataFrame(place, "team int, middle int, block int")
        tables = written(tables.join(where, ["team", "middle"], "left").repartitionByRange(F.coalesce("block", F.lit(-1)), "team").sortWithinPartitions("block"), "blocks")
    else:
        tables = tables.withColumn("block", F.lit(0))

    parts = []
    for b, (g, members, own) in enumerate(plan):
        rows = tables.where((F.col("team") == g) & ((F.col("k") == 1) | (F.col("block") == b))).select("lang", "k", "gram", "n").toArrow()
        found: dict[int, dict] = {k: {} for k in range(1, order + 1)}
        for k in found:
            of_order = rows.filter(pc.equal(rows.column("k"), k))
            for lang in members:
                some = of_order.filter(pc.equal(of_order.column("lang"), lang))
                if some.num_rows:
                    found[k][lang] = (code_points(some.column("gram").to_pylist(), k), some.column("n").to_numpy().astype(np.float64))
        middles = None
        if sum(x[0] == g for x in plan) > 1:  # the first block of a team also has the characters that no model knows
            first = b == min(i for i, x in enumerate(plan) if x[0] == g)
            middles = np.full(0x110000, first)
            middles[[m for i, x in enumerate(plan) if x[0] == g and i != b for m in x[2]]] = False
            middles[own] = True
        model = KneserNey.block(members, found, discounts, alphabet, order, middles)
        parts.append((g * block_languages, spark.sparkContext.broadcast(model)))
    return Models(languages, parts)


def calibration(docs: DataFrame, model: Models) -> tuple[float, float]:
    """(sharpness, threshold) from labelled ``docs``: least log loss, then at most MAX_ERROR wrong above the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for block in blocks(batches, "text", model.text_bytes):
            if not model.languages:
                continue
            entropies, n_letters = model.entropies(block.column("text").to_pylist())
            truth = np.array([model.languages.index(x) if x in model.languages else -1 for x in block.column("lang").to_pylist()])
            use = (truth >= 0) & (n_letters > 0)
            for s in SHARPNESS if use.any() else ():
                p = posterior(entropies[use], s)
                loss, right = -np.log(np.maximum(p[np.arange(len(p)), truth[use]], 1e-300)), p.argmax(axis=1) == truth[use]
                for t in THRESHOLDS:
                    over = p.max(axis=1) >= t
                    cell = total.setdefault((s, t), [0.0, 0, 0])
                    for i, x in enumerate((loss.sum(), over.sum(), (over & ~right).sum())):
                        cell[i] += x
        rows = [(s, t, float(a), int(b), int(c)) for (s, t), (a, b, c) in total.items()]
        kinds = [pa.float64()] * 3 + [pa.int64()] * 2
        yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["s", "t", "loss", "over", "wrong"])

    sums = docs.select("lang", "text").mapInArrow(run, "s double, t double, loss double, over long, wrong long")
    rows = sums.groupBy("s", "t").agg(F.sum("loss").alias("loss"), F.sum("over").alias("over"), F.sum("wrong").alias("wrong")).collect()
    if not rows:
        return 16.0, 0.5
    sharp = min(rows, key=lambda r: (round(r.loss, 6), r.s)).s
    safe = [r.t for r in rows if r.s == sharp and r.wrong <= MAX_ERROR * r.over]
    return sharp, min(safe, default=max(THRESHOLDS))


def language_ids(docs: DataFrame, training: DataFrame) -> DataFrame:
    """The language of every whole text.

    ``docs`` needs ``doc_id`` and ``text``; ``training`` has ``lang`` (not null), ``part`` (0 fits and
    is in the final model, 1 is in the final model and calibrates it) and ``text``. One row a row:
    ``doc_id``, ``lang_pred``, ``score`` (0 to 1), ``rejected`` (score below the calibrated threshold).
    Null texts and texts without a letter get ``und`` and 0.0, as do all texts without training rows.
    Ties go to the first language in code point order. Repeated rows stay.
    """
    counts = written(training_counts(training.where("lang is not null and text is not null")), "grams")
    sharp, threshold = calibration(training.where("part = 1 and lang is not null and text is not null"), model_of(counts.where("part = 0")))
    model = model_of(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", model.text_bytes):
            names, score = np.full(block.num_rows, UNKNOWN, object), np.zeros(block.num_rows)
            if model.languages:
                entropies, n_letters = model.entropies(block.column("text").to_pylist())
                p = posterior(entropies, sharp)
                best = entropies.argmin(axis=1)
                known = n_letters > 0
                names[known] = np.array(model.languages, object)[best[known]]
                score[known] = np.clip(p[np.arange(len(p)), best][known], 0, 1)
            low = (score < threshold) | (names == UNKNOWN)
            yield pa.record_batch([block.column("doc_id"), pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(low)], ["doc_id", "lang_pred", "score", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all documents, learned from those whose id does not hash to fold 2 of 4.

    Fold 3 calibrates. A null id belongs to no fold: it is neither learned from nor held out.
    """
    docs = read_table(spark, folder, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    training = docs.where(fold != 2).select("lang", "text", (fold == 3).cast("int").alias("part"))
    found = language_ids(docs, training)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
