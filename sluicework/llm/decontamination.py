"""Benchmark decontamination: rare word-pair seeds join documents to items, then Smith-Waterman alignment.

1. Texts become words: lower case, ASCII punctuation as white space.
2. A pair of a document and an item is a leak if the best local alignment by words (match 2, mismatch
   -1, gap -1) has ``LEAST_SCORE`` or more of the item's own score.
3. A seed is two words of an item that are next to each other or have one word between them, and it hits
   such a pair of words in a document. For an item of m words and a least score s, an alignment with a
   matches and edits of cost e has 2a - e >= 2ms. Of the a - 1 gaps between its matches at most
   e / 2 <= a - ms cost 2 or more, and each other one is a hit: at least ms - 1 of them, at places
   within a + e <= (3 - 2s)m words of the document and from as many places of the item.
4. So of an item's places all but ms - ``ASK`` - 1 or so have to be looked for: a leak hits ``ASK`` of these. One scan counts how often each
   seed occurs in all documents, and the places with the most frequent seeds are the ones left out.
5. Another scan gives the places in documents of the rare seeds that are left, behind a Bloom filter of bounded size, and these are
   joined with the items on the seed. That is two scans, however many items there are. Hits are counted in
   windows of documents, and windows with ``ASK`` places of an item stay.
6. A scan behind a filter of the documents with such windows picks these, so that no other text is shuffled. The words around such a window are joined with the item's. Where all of its seeds have hits enough, and from enough of its places, they
   are aligned. So no leak is missed, however it is edited and however
   often its words occur elsewhere, and the score is that of aligning with the whole document.

Edge cases: null and empty texts, of documents or items, match nothing; of an item of two words both
must occur; where ms <= 1 the seeds are single words; documents alike in id and text are one; repeated items each
count; null ids are ids; long texts are searched whole; empty tables give no row; other columns
are ignored by ``leaks`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.llm.common import bounded_batches, materialize, mix, table, text_or_empty, word_hashes

LEAST_SCORE = 0.5
#: The filter takes so many bits for a seed, and so many at most (64 MB); beyond them it lets more pass.
SEED_BITS, MOST_BITS = 16, 1 << 29
#: Places of an item whose rare seeds have to be near one another in a document, for it to be looked at.
ASK = 3
#: Bits of one part of the filter, as it is built.
PART_BITS = 1 << 20
#: Hits that a task holds at a time, but for those of one document.
HITS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)


def plain_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts without case and ASCII punctuation, and how many each text has."""
    return word_hashes([t.lower().encode().translate(_PUNCTUATION) for t in texts])


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """The best local alignment's share of the item's own score, and where it starts and ends in the passage.

    A row of the matrix at a time; gaps along a row are a running maximum.
    """
    n, steps = len(passage), np.arange(len(passage) + 1, dtype=np.float64)
    best, end = 0.0, 0
    row, origin = np.zeros(n + 1), np.arange(n + 1)
    start = 0
    for word in item:
        up = row - 1.0
        diagonal = np.r_[-1.0, row[:-1] + np.where(passage == word, 2.0, -1.0)]
        from_diagonal = diagonal >= up
        cell = np.maximum(np.where(from_diagonal, diagonal, up), 0.0)
        came = np.where(from_diagonal, np.r_[0, origin[:-1]], origin)
        came = np.where(cell > 0, came, np.arange(n + 1))
        lifted = cell + steps
        run = np.maximum.accumulate(lifted)
        last = np.maximum.accumulate(np.where(lifted == run, np.arange(n + 1), 0))
        row, origin = run - steps, came[last]
        top = int(row.argmax())
        if row[top] > best:
            best, end, start = float(row[top]), top, int(origin[top])
    return best / (2.0 * len(item)), start, end


def pairs(words: np.ndarray, counts: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word with the one ``step`` words on in its text (0: of single words), and the places of the first."""
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))
    at = np.flatnonzero(left > step)
    return (mix(words[at] * _BASE + words[at + step]) if step else words[at]), at


class Seeds:
    """The seeds of some items, sorted by hash; how many hits within how many words an item needs."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, least_score: float = LEAST_SCORE):
        self.n = len(counts)
        ends = np.cumsum(counts)
        self.words = [words[e - n : e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
        self.need = np.maximum(np.ceil(counts * least_score - 1 - 1e-9), 1).astype(np.int64)
        self.span = np.ceil(counts * max(3 - 2 * least_score, 1)).astype(np.int64) + 1
        single = (counts == 1) | ((counts > 2) & (counts * least_score <= 1 + 1e-9))
        owner, grams, item, first = np.repeat(np.arange(len(counts)), counts), [], [], []
        for step in (0, 1, 2):
            gram, at = pairs(words, counts, step)
            mine = single[owner[at]] == (step == 0)
            grams.append(gram[mine])
            item.append(owner[at][mine])
            first.append((at - (ends - counts)[owner[at]])[mine])
        #: For each place of each item the seeds that begin there: item, place, gram.
        self.at_places = np.concatenate(item), np.concatenate(first), np.concatenate(grams)
        self.steps = [k for k, g in enumerate(grams) if len(g) or k]
        gram, at = np.concatenate(grams), np.concatenate(item)
        order = np.lexsort([at, gram])
        gram, at = gram[order], at[order]
        new = np.r_[True, (np.diff(gram) != 0) | (np.diff(at) != 0)][: len(gram)]
        self.grams, self.item = gram[new], at[new]

    def search(self, words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, float, int, int, int]]:
        """The best passage of each document for each item that may leak: (document, item, score, start, end, hits)."""
        ends = np.cumsum(counts)
        owner, found, low, n = np.repeat(np.arange(len(counts)), counts), [], [], []
        for step in self.steps:
            gram, at = pairs(words, counts, step)
            first = np.searchsorted(self.grams, gram)
            hit = np.flatnonzero(self.grams[np.minimum(first, len(self.grams) - 1)] == gram)
            found.append(at[hit])
            low.append(first[hit])
            n.append(np.searchsorted(self.grams, gram[hit], side="right") - first[hit])
        found, low, n = (np.concatenate(x) for x in (found, low, n))
        order = np.argsort(found, kind="stable")
        found, low, n = found[order], low[order], n[order]
        upto = np.r_[0, np.cumsum(n)][np.searchsorted(found, ends)]  # hits in the documents so far
        at = 0
        while at < len(counts):
            till = max(int(np.searchsorted(upto, (upto[at - 1] if at else 0) + HITS, side="right")), at + 1)
            a, b = np.searchsorted(found, [ends[at] - counts[at], ends[till - 1]])
            yield from self._passages(words, ends, counts, owner, found[a:b], low[a:b], n[a:b])
            at = till

    def _places(self, i: int, passage: np.ndarray) -> int:
        """At how many of its places an item has a seed that hits the passage; a hit's place in the item is its own, too."""
        own, hit = self.words[i], np.zeros(len(self.words[i]), bool)
        of_item, of_passage = ([pairs(w, np.array([len(w)]), step) for step in self.steps] for w in (own, passage))
        grams = np.concatenate([gram for gram, _ in of_passage])
        for gram, at in of_item:
            hit[at[np.isin(gram, grams)]] = True
        return int(hit.sum())

    def _passages(self, words: np.ndarray, ends: np.ndarray, counts: np.ndarray, owner: np.ndarray, found: np.ndarray, low: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, float, int, int, int]]:
        seed = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        place = np.repeat(found, n)
        key = np.sort((owner[place] * self.n + self.item[seed]) * len(words) + place)
        if not len(key):
            return
        key = key[np.r_[True, np.diff(key) != 0]]
        group, place = key // len(words), key % len(words)
        item = group % self.n
        last = np.arange(len(key)) + self.need[item] - 1
        ends_in = np.minimum(last, len(key) - 1)
        dense = np.flatnonzero((last < len(key)) & (group[ends_in] == group) & (place[ends_in] - place < self.span[item]))
        change = np.bincount(dense, minlength=len(key) + 1) - np.bincount(last[dense] + 1, minlength=len(key) + 1)
        keep = np.flatnonzero(np.cumsum(change)[:-1] > 0)
        best: dict[int, tuple[float, int, int, int]] = {}
        for run in np.split(keep, np.flatnonzero((np.diff(group[keep]) != 0) | (np.diff(place[keep]) >= self.span[item[keep[1:]]])) + 1):
            if not len(run):
                continue
            g, i = int(group[run[0]]), int(item[run[0]])
            d = g // self.n
            begin, reach = int(ends[d] - counts[d]), int(self.span[i])
            first, stop = max(int(place[run[0]]) - reach, begin), min(int(place[run[-1]]) + reach, int(ends[d]))
            if self._places(i, words[first:stop]) < self.need[i]:
                continue
            score, x, y = align(self.words[i], words[first:stop])
            best[g] = max(best.get(g, (0.0, 0, 0, 0)), (score, first - begin + x, first - begin + y, len(run)))
        for g, x in best.items():
            yield (g // self.n, g % self.n, *x)


class Filter:
    """A Bloom filter of seeds: a bit map whose size is a power of two."""

    def __init__(self, parts: dict[int, bytes], bits: int):
        self.bits = bits
        self.map = np.zeros(bits // 8, np.uint8)
        for part, data in parts.items():
            self.map[part * PART_BITS // 8 :][: len(data)] = np.frombuffer(data, np.uint8)

    @staticmethod
    def places(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        spread, last = mix(grams ^ np.uint64(0xD6E8FEB86659FD93)), np.uint64(bits - 1)
        return ((spread & last).astype(np.int64), (spread >> np.uint64(32) & last).astype(np.int64))

    def passes(self, grams: np.ndarray) -> np.ndarray:
        a, b = self.places(grams, self.bits)
        return ((self.map[a >> 3] >> (a & 7).astype(np.uint8)) & (self.map[b >> 3] >> (b & 7).astype(np.uint8)) & np.uint8(1)).astype(bool)


def seed_filter(seeds: DataFrame, most_bits: int = MOST_BITS) -> Broadcast:
    """The filter of all values of ``gram``, which may be repeated: its parts are built by tasks, and what comes to the driver has a bounded size."""
    spark, n = seeds.sparkSession, seeds.agg(F.approx_count_distinct("gram")).first()[0]  # only the filter's size hangs on it
    bits = min(max(1 << 16, 1 << int(max(n, 1) * SEED_BITS - 1).bit_length()), most_bits)

    def ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(Filter.places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(at // PART_BITS), pa.array(at % PART_BITS)], names=["part", "at"])

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(min(PART_BITS, bits), np.uint8)
        on[rows["at"].to_numpy()] = 1
        return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "data": [np.packbits(on, bitorder="little").tobytes()]})

    parts = seeds.select("gram").mapInArrow(ones, "part long, at long").distinct().groupBy("part").applyInPandas(build, "part long, data binary")
    return spark.sparkContext.broadcast(Filter({r["part"]: bytes(r["data"]) for r in parts.collect()}, bits))


def _item_words(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """A row per item with words: item (a number), item_id, words, n_words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = plain_words(batch.column(1).to_pylist())
            parts = [x.tobytes() for x in np.split(words, np.cumsum(counts)[:-1])] if len(counts) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary()), pa.array(counts, pa.int64())], names=["item_id", "words", "n_words"])

    rows = items.select(F.col(item_col).cast("long").alias("item_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, "item_id long, words binary, n_words long")
    return materialize(rows.where("n_words > 0").withColumn("item", F.monotonically_increasing_id()), "items")


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of rows of their bytes, and how many each row has."""
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), np.uint64), np.array([len(x) // 8 for x in data], np.int64)


def _seeds(items: DataFrame, least_score: float) -> DataFrame:
    """item, place, gram, need (places that a leak hits), span, single (whether seeds are single words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = _joined(batch.column(1))
            if not len(counts):
                continue
            seeds = Seeds(words, counts, least_score)
            item, place, gram = seeds.at_places
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(item)), pa.array(place), pa.array(gram.view(np.int64)), pa.array(seeds.need[item]), pa.array(seeds.span[item]), pa.array([0 in seeds.steps] * len(item))], names=["item", "place", "gram", "need", "span", "single"])

    return items.select("item", "words").mapInArrow(run, "item long, place long, gram long, need long, span long, single boolean")


def _grams(words: np.ndarray, counts: np.ndarray, steps: tuple[int, ...], passing: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Word pairs of some texts that the filter lets pass, and the places of their first words."""
    found = [pairs(words, counts, step) for step in steps]
    gram, at = (np.concatenate(x) for x in zip(*found, strict=True))
    yes = passing.passes(gram)
    return gram[yes], at[yes]


def rare_seeds(rows: DataFrame, seeds: DataFrame, steps: tuple[int, ...], most_bits: int = MOST_BITS) -> DataFrame:
    """item, place, gram, span and ask of an item's rarest seeds in ``rows`` (text): from so many places that a leak hits ``ask`` of them."""
    every = seed_filter(seeds, most_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, n = np.unique(_grams(*plain_words(batch.column(0).to_pylist()), steps, every.value)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], names=["gram", "n"])

    often = materialize(rows.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "often")
    places = seeds.join(often, "gram", "left").groupBy("item", "place").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.first("need").alias("need"))
    places = places.withColumn("ask", F.least("need", F.lit(ASK)))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("n").desc(), "place"))
    kept = places.withColumn("rank", rank).where("rank > need - ask").select("item", "place", "ask")
    return materialize(seeds.join(kept, ["item", "place"]).select("item", "place", "gram", "span", "ask"), "rare")


def _suspects(rows: DataFrame, found: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows (doc_id, th, text) that have a row in ``found``, and few others: the texts without any aren't sent by the join that follows."""
    key = F.xxhash64("doc_id", "th")
    passing = seed_filter(found.select(key.alias("gram")), most_bits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = passing.value.passes(batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64))
            yield batch.select(["doc_id", "th", "text"]).filter(pa.array(yes))

    return materialize(rows.select("doc_id", "th", "text", key.alias("key")).mapInArrow(keep, "doc_id long, th long, text string"), "suspects")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least_score: float = LEAST_SCORE, most_bits: int = MOST_BITS) -> DataFrame:
    """A row for each document and item that it leaks: doc_id, th, item_id, score, start_word, end_word, n_hits."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("th"), text_or_empty(text_col).alias("text"))
    item = _item_words(items, item_col, item_text_col)
    seeds = materialize(_seeds(item, least_score), "seeds")
    steps = (0, 1, 2) if seeds.where("single").limit(1).count() else (1, 2)
    rare = rare_seeds(rows, seeds, steps, most_bits)
    passing = seed_filter(rare, most_bits)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = plain_words(batch.column(2).to_pylist())
            gram, at = _grams(words, counts, steps, passing.value)
            owner = np.repeat(np.arange(len(counts)), counts)[at]
            place = at - (np.cumsum(counts) - counts)[owner]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)), pa.array(gram.view(np.int64)), pa.array(place)], names=["doc_id", "th", "gram", "at"])

    found = rows.mapInArrow(hits, "doc_id long, th long, gram long, at long").join(rare, "gram")
    slot = F.floor(F.col("at") / F.col("span"))
    found = found.select("doc_id", "th", "item", "place", "span", "ask", F.explode(F.array(slot, slot - 1)).alias("slot"))  # a window is two slots
    found = found.groupBy("doc_id", "th", "item", "slot", "span", "ask").agg(F.size(F.collect_set("place")).alias("n")).where("n >= ask")
    found = materialize(found.select("doc_id", "th", "item", "slot", "span"), "hits")
    wanted = found.groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t")).agg(F.collect_list(F.struct("item", "slot", "span")).alias("wanted"))
    near = _suspects(rows, found, most_bits).join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))).select("doc_id", "th", "text", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words around the windows of each item: windows that touch together, and a slot more on both sides."""
        for batch in batches:
            got = []
            for doc, th, text, slots in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, _ = plain_words([text])
                last = None
                for x in sorted(slots, key=lambda x: (x["item"], x["slot"])):
                    low, high = (x["slot"] - 1) * x["span"], (x["slot"] + 3) * x["span"]
                    if last is not None and last[0] == x["item"] and low <= last[2]:
                        last[2] = high
                        continue
                    last = [x["item"], max(low, 0), high]
                    got.append((doc, th, last, words))
            for at in range(0, max(len(got), 1), 4096):
                part = got[at : at + 4096]
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in part], pa.int64()), pa.array([g[1] for g in part], pa.int64()), pa.array([g[2][0] for g in part], pa.int64()), pa.array([g[2][1] for g in part], pa.int64()), pa.array([g[3][g[2][1] : g[2][2]].tobytes() for g in part], pa.binary())], names=["doc_id", "th", "item", "start", "passage"])

    passages = materialize(near.mapInArrow(cut, "doc_id long, th long, item long, start long, passage binary"), "passages")  # so that no task runs two Python workers
    passages = passages.join(item.select("item", "item_id", "words"), "item")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Seeds] = {}
        for batch in batches:
            got = []
            for doc, th, number, item_id, start, own, passage in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number not in known:
                    if len(known) >= 1024:
                        known.clear()
                    known[number] = Seeds(np.frombuffer(own, np.uint64), np.array([len(own) // 8]), least_score)
                words = np.frombuffer(passage, np.uint64)
                for _, _, score, first, end, n in known[number].search(words, np.array([len(words)])):
                    if score >= least_score:
                        got.append((doc, th, number, item_id, score, start + first, start + end, n))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*got, strict=True)) if got else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "th", "item", "item_id", "score", "start_word", "end_word", "n_hits"])

    judged = passages.select("doc_id", "th", "item", "item_id", "start", "words", "passage").mapInArrow(judge, "doc_id long, th long, item long, item_id long, score double, start_word long, end_word long, n_hits long")
    best = judged.groupBy("doc_id", "th", "item", "item_id").agg(F.max(F.struct("score", "start_word", "end_word", "n_hits")).alias("best"))
    return best.select("doc_id", "th", "item_id", "best.*")


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns."""
    bad = materialize(leaks(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias("bad_id__"), F.col("th").alias("bad_th__")).distinct(), "leaks")
    key, th = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))
    return docs.join(bad, key.eqNullSafe(F.col("bad_id__")) & (th == F.col("bad_th__")), "left_anti")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all test items: a row per leak: doc_id, item_id, score, start_word, end_word, n_hits."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")
