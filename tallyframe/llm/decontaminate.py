"""Benchmark decontamination: passages within a few word edits of a benchmark item.

1. Seeds. A passage within d word edits of an item of m words shares at least m - 2 - 3d of its word
   triples. Only starts whose following m + d words hold that many triples of the benchmark go on;
   nothing within the distance is lost, and clean text ends here.
2. CGK embedding. From each start a walk reads words and, by a random bit of the step and the word,
   moves on or stays. Walks over texts at small edit distance fall into step again after an edit, so
   edit distance becomes Hamming distance between walks. Each repetition has its own random bits.
3. Bit sampling. Each table compares a few steps of the walk; items and windows whose samples agree in
   any of the tables are candidates. Steps are sampled from the part of the walk that lies inside an
   item of that length class, so windows are item-sized.
4. Verification. The smallest edit distance between the item and any run of words around the start,
   over the words themselves, decides.

Words are letters and digits of any script, lower case, so upper-cased or decorated copies match too; in
scripts without spaces every sign is a word. How many steps a table compares and how many tables there are is
set per length class when the index is built: edited copies of its items are made at the edit limit,
and the cheapest setting that finds the target share of them is taken. The benchmark travels to the
tasks in blocks of a bounded number of words; documents are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, give_back, read_table
from .wordblocks import NOT_ALNUM, WordBlock, forget_powers, mixed, run_hashes

SIMILARITY = 0.8
SEED_WORDS = 3
REPEATS = 4  # random walks
SETTINGS = ((4, 8), (3, 8), (2, 8), (2, 16), (1, 8), (1, 16), (1, 32))  # steps a table compares and tables a walk, cheapest first
MOST_TABLES = 64
TARGET_RECALL = 0.98
TRIALS = 200  # edited copies a length class, made when the index is built
CLASS_RATIO = 1.15
WALK = 1.6  # steps a word; a walk needs two steps a word on average, so most samples are inside
BLOCK_WORDS = 1_000_000
STARTS = 1 << 14
BLOOM = 1 << 20


def lower(texts: pa.Array) -> pa.Array:
    """Lower case; outside ASCII, signs that are no letters or digits become spaces and ideographs words."""
    low = pc.utf8_lower(texts.cast(pa.large_string()))
    other = pc.fill_null(pc.invert(pc.string_is_ascii(low)), False)
    if not pc.any(other).as_py():
        return low
    plain = pc.replace_substring_regex(low.filter(other), r"[^\pL\pN\pM]+", " ")
    return pc.replace_with_mask(low, other, pc.replace_substring_regex(plain, f"([{SPACELESS}])", r" \1 "))


SPACELESS = "".join(rf"\p{{{name}}}" for name in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))


def allowed_edits(m: int, similarity: float = SIMILARITY) -> int:
    """Word edits an item of ``m`` words may differ by; fewer where no seed would be left to share."""
    d = int(math.floor(m * (1 - similarity) + 1e-9))
    return max(0, min(d, (m - SEED_WORDS) // SEED_WORDS))


def nearest_run(item: list, words: list) -> tuple[int, int, int]:
    """(edits, begin, end): the run of ``words`` nearest to ``item`` in edits; earliest end, then earliest begin on ties.

    A cell of the table holds edits and where the run began in one number, so that the least of both is kept.
    """
    codes = {w: n for n, w in enumerate(dict.fromkeys(item))}
    mine = np.array([codes[w] for w in item], np.int64)
    down = np.arange(len(item) + 1, dtype=np.int64) << 32
    cost, best = down.copy(), (len(item), 0, 0)
    for j, w in enumerate(words, 1):
        new = cost + (1 << 32)
        new[0] = j
        np.minimum(new[1:], cost[:-1] + ((mine != codes.get(w, -1)).astype(np.int64) << 32), out=new[1:])
        cost = np.minimum.accumulate(new - down) + down
        last = int(cost[-1])
        if last >> 32 < best[0]:
            best = (last >> 32, last & 0xFFFFFFFF, j)
    return best


def edited_copy(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """The words after so many random replacements, insertions and deletions; new words are unlike any other."""
    out = words.tolist()
    for _ in range(edits):
        at, kind, fresh = int(rng.integers(0, max(1, len(out)))), int(rng.integers(0, 3)), int(rng.integers(0, 1 << 63))
        if kind == 0 and out:
            out[at] = fresh
        elif kind == 1 or not out:
            out.insert(at, fresh)
        else:
            del out[at]
    return np.array(out, np.uint64)


class BenchmarkIndex:
    """Seeds, walk samples and words of a bounded block of benchmark items."""

    def __init__(self, items: list[tuple], similarity: float = SIMILARITY, seed: int = 7):
        rng = np.random.default_rng(seed)
        text = WordBlock(lower(pa.array([t for _, t in items], pa.string())), NOT_ALNUM)
        words, data = text.hashes(), text.data.tobytes()
        spell = [data[a:b] for a, b in zip(text.starts.tolist(), text.ends.tolist())]
        self.items = [(i, spell[a:b]) for (i, _), a, b in zip(items, text.first[:-1].tolist(), text.first[1:].tolist()) if b - a >= SEED_WORDS]
        self.edits = [allowed_edits(len(w), similarity) for _, w in self.items]
        ranges = [(a, b) for a, b in zip(text.first[:-1], text.first[1:]) if b - a >= SEED_WORDS]
        seeds = [run_hashes(words[a:b], SEED_WORDS) for a, b in ranges]
        self.seeds = np.unique(np.concatenate(seeds)) if seeds else np.zeros(0, np.uint64)
        self.bloom = np.zeros(BLOOM, bool)
        self.bloom[(self.seeds % np.uint64(BLOOM)).astype(np.int64)] = True
        sizes = np.array([b - a for a, b in ranges], np.int64)
        self.reach = {}  # words to look at -> fewest seeds of any item that long
        for m, d in zip(sizes.tolist(), self.edits):
            self.reach[m + d] = min(self.reach.get(m + d, m), m - SEED_WORDS + 1 - SEED_WORDS * d)
        grade = np.floor(np.log(np.maximum(sizes, 1)) / math.log(CLASS_RATIO)).astype(np.int64)
        steps = {g: max(1, int(WALK * sizes[grade == g].min())) for g in sorted(set(grade.tolist()))}
        self.steps = max(steps.values(), default=0)
        self.bits = rng.integers(0, 1 << 63, (REPEATS, max(1, self.steps)), dtype=np.uint64) | np.uint64(1)
        self.own_seeds = [np.unique(x) for x in seeds]
        self.samples, self.recall = {}, {}
        for g, n in steps.items():
            some = [(words[a:b], self.edits[i]) for i, (a, b) in enumerate(ranges) if grade[i] == g]
            self.samples[g], self.recall[g] = self.tuned(some, n, rng)
        keys, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        padded = np.concatenate([words, np.zeros(self.steps + 1, np.uint64)])
        starts = np.array([a for a, _ in ranges], np.int64)
        for g in steps:
            mine = np.flatnonzero(grade == g)
            for key in self.keys(padded, starts[mine], g):
                keys.append(key)
                owner.append(mine)
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(keys, kind="stable")
        self.key, self.owner = keys[order], owner[order]

    def tuned(self, items: list[tuple[np.ndarray, int]], steps: int, rng: np.random.Generator) -> tuple[list, float]:
        """The sampled steps of each table of each walk, and the share of edited copies they find."""
        rows = [items[i] for i in rng.integers(0, len(items), TRIALS)]
        pair = [(w, edited_copy(w, d, rng)) for w, d in rows]
        texts = [x for both in pair for x in both]
        padded = np.concatenate([np.append(x, np.zeros(self.steps + 1, np.uint64)) for x in texts])
        starts = np.cumsum([0, *(len(x) + self.steps + 1 for x in texts[:-1])])
        same = []  # by walk: whether the item and its copy read the same word at each step
        for r in range(REPEATS):
            walk = self.walks(padded, starts, r)[:steps]
            same.append(walk[:, 0::2] == walk[:, 1::2])
        for size, tables in SETTINGS:
            samples = [[rng.integers(0, steps, size) for _ in range(tables)] for _ in range(REPEATS)]
            found = np.zeros(TRIALS, bool)
            for r in range(REPEATS):
                for sample in samples[r]:
                    found |= same[r][sample].all(axis=0)
            if found.mean() >= TARGET_RECALL:
                break
        return samples, float(found.mean())

    def walks(self, words: np.ndarray, starts: np.ndarray, repeat: int) -> np.ndarray:
        """Words read at each step, a row a start."""
        at, out = starts.copy(), np.empty((self.steps, len(starts)), np.uint64)
        for j in range(self.steps):
            out[j] = words[at]
            at += ((out[j] * self.bits[repeat, j]) >> np.uint64(63)).astype(np.int64)
        return out

    def keys(self, words: np.ndarray, starts: np.ndarray, grade: int | None = None) -> Iterator[np.ndarray]:
        """A key per table for each start; for every length class, or for one."""
        for r in range(REPEATS):
            walk = self.walks(words, starts, r)
            for g in self.samples if grade is None else [grade]:
                for t, sample in enumerate(self.samples[g][r]):
                    key = np.full(len(starts), (g * REPEATS + r) * MOST_TABLES + t + 1, np.uint64)
                    for j in sample:
                        key = mixed(key ^ walk[j])
                    yield key

    def active_starts(self, words: np.ndarray) -> np.ndarray:
        """Starts followed by enough seeds for some item."""
        triples = run_hashes(words, SEED_WORDS)
        near = np.flatnonzero(self.bloom[(triples % np.uint64(BLOOM)).astype(np.int64)])
        found = self.seeds[np.minimum(np.searchsorted(self.seeds, triples[near]), len(self.seeds) - 1)] == triples[near]
        near = near[found]
        if not len(near):
            return near
        counts = np.zeros(len(triples) + 1, np.int32)
        counts[near + 1] = 1
        counts = np.cumsum(counts, dtype=np.int32)
        # A start stands at most the longest reach before a seed; only those places are looked at.
        most = max(self.reach)
        spread = np.zeros(len(triples) + 1, np.int32)
        np.add.at(spread, np.maximum(near - most, 0), 1)
        np.add.at(spread, near + 1, -1)
        starts = np.flatnonzero(np.cumsum(spread[:-1]) >= min(self.reach.values()))
        good = np.zeros(len(starts), bool)
        for reach, least in self.reach.items():
            good |= counts[np.minimum(starts + max(reach - SEED_WORDS + 1, 1), len(triples))] - counts[starts] >= least
        return starts[good]

    def matches(self, text: WordBlock) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, first word, words): the nearest place of each item in each text."""
        words = text.hashes()
        if not len(self.items) or len(words) < SEED_WORDS:
            return []
        starts = self.active_starts(words)
        if not len(starts):
            return []
        owner, found = text.text_of(), [np.zeros(0, np.int64)]
        padded, items = np.concatenate([words, np.zeros(self.steps + 1, np.uint64)]), len(self.items)
        for i in range(0, len(starts), STARTS):
            part, pairs = starts[i:i + STARTS], [np.zeros(0, np.int64)]
            for key in self.keys(padded, part):
                low = np.searchsorted(self.key, key)
                hit = np.flatnonzero(self.key[np.minimum(low, len(self.key) - 1)] == key)
                low, count = low[hit], np.searchsorted(self.key, key[hit], "right") - low[hit]
                place = np.arange(count.sum()) + np.repeat(low - np.cumsum(count) + count, count)
                pairs.append(np.unique(np.repeat(part[hit], count) * items + self.owner[place]))
            found.append(np.unique(np.concatenate(pairs)))
        best, data = {}, text.data
        spans: dict[tuple[int, int], list[int]] = {}
        for s, o in zip(*(v.tolist() for v in np.divmod(np.concatenate(found), items))):
            spans.setdefault((int(owner[s]), o), []).append(s)
        for (j, o), places in spans.items():
            item, d = self.items[o][1], self.edits[o]
            floor, ceiling, end = max(int(text.first[j]), places[0] - d), min(int(text.first[j + 1]), places[-1] + 2 * len(item) + 2 * d), -1
            shared = np.concatenate([[0], np.cumsum(np.isin(run_hashes(words[floor:ceiling], SEED_WORDS), self.own_seeds[o]))])
            for s in places:
                if s <= end:  # inside the stretch that was compared last
                    continue
                low = max(floor, s - d)
                high = min(ceiling, s + len(item) + len(item) + 2 * d)
                # Fewer of the item's own triples than any passage within the distance shares: no need to compare words.
                if shared[max(high - floor - SEED_WORDS + 1, low - floor)] - shared[low - floor] < len(item) - SEED_WORDS + 1 - SEED_WORDS * d:
                    continue
                end = s + len(item)
                run = [data[a:b].tobytes() for a, b in zip(text.starts[low:high].tolist(), text.ends[low:high].tolist())]
                exact = s - low
                if run[exact:exact + len(item)] == item:
                    edits, a, b = 0, exact, exact + len(item)
                else:
                    edits, a, b = nearest_run(item, run)
                if edits <= d and (edits, low + a) < best.get((j, o), (d + 1, 0, 0))[:2]:
                    best[j, o] = (edits, low + a, b - a)
        return [(j, o, e, a - int(text.first[j]), n) for (j, o), (e, a, n) in best.items()]


def benchmark_blocks(benchmark: DataFrame, similarity: float = SIMILARITY, block_words: int = BLOCK_WORDS) -> Iterator[BenchmarkIndex]:
    """Indexes over blocks of the benchmark, each of about ``block_words`` words."""
    items = benchmark.where("text is not null").select("item_id", "text").distinct()
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    count = max(1, math.ceil(total / block_words))
    for b in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b) if count > 1 else items
        rows = sorted(map(tuple, part.collect()), key=lambda r: (r[0] is None, r[0], r[1]))
        if rows:
            yield BenchmarkIndex(rows, similarity)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Benchmark items found in documents.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` needs ``item_id`` and ``text``; other columns
    are ignored. One row for each document and item within the distance: ``doc_id``, ``item_id``,
    ``edits``, ``first_word``, ``n_words`` of the nearest place (the earliest on ties). Null and blank
    texts match nothing, items of fewer than three words are not searched, repeated rows count once,
    an empty table gives no rows. Nulls ids are kept as they are.
    """
    spark = docs.sparkSession
    kinds = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kinds[0]), T.StructField("item_id", kinds[1]),
                           *[T.StructField(c, T.LongType()) for c in ("edits", "first_word", "n_words")]])
    found = None
    for index in benchmark_blocks(benchmark, similarity):
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, "text"):
                rows = held.value.matches(WordBlock(lower(block.column("text")), NOT_ALNUM))
                at = pa.array([r[0] for r in rows], pa.int64())
                names = pa.array([held.value.items[r[1]][0] for r in rows]).cast(out[1].type) if rows else pa.array([], out[1].type)
                yield pa.record_batch([block.column("doc_id").take(at), names, *[pa.array([r[k] for r in rows], pa.int64()) for k in (2, 3, 4)]], schema=out)

        out = _arrow(schema)
        part = docs.select("doc_id", "text").mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema)
    best = F.min(F.struct("edits", "first_word", "n_words")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; nothing is shuffled."""
    for index in benchmark_blocks(benchmark, similarity):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, "text"):
                bad = {r[0] for r in held.value.matches(WordBlock(lower(block.column("text")), NOT_ALNUM))}
                yield block.take(pa.array([i for i in range(block.num_rows) if i not in bad], pa.int64()))
            forget_powers()
            give_back()

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in all documents."""
    return benchmark_matches(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
