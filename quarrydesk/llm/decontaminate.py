"""Benchmark decontamination: BM25 over an inverted index of test items, searched by block maxima.

Every passage of every document is a query. All items above a share of their own best score are retrieved: terms too
common to lift any item over it are not looked at first, cursors over the other terms' postings find the items by
block-max WAND, and what they find is scored in full. A hit counts when the passage also holds enough of the word
sequences of both the item's question and its answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrydesk.llm.words import Words, slices, text_bytes
from quarrydesk.session import write_out

K1, B = 1.2, 0.75
#: Items of one index, at most about so many; more items make more indexes, each of which meets every document. All have
#: the statistics of the whole table, so their number changes no score.
INDEX_ITEMS = 10_000
#: Items of a block of an index, with one largest impact for each term.
BLOCK_ITEMS = 32
SCORE_SHARE = 0.6
#: Common terms may hold at most this share of an item's score; the others are looked up first.
COMMON_SHARE = 0.3
OVERLAP_WORDS, OVERLAP_SHARE = 5, 0.5

_HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score_share", pa.float64()),
                   ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
_HITS_DDL = "doc_id long, item_id long, score_share double, question_overlap double, answer_overlap double"
_GATE_BITS = 16
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = 0x20


def plain_words(column: pa.Array) -> Words:
    """Words of lower-cased texts whose ASCII punctuation is taken as blanks."""
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    return Words(_PLAIN[data], offsets)


@dataclass(frozen=True)
class Index:
    item_ids: np.ndarray
    terms: np.ndarray  # sorted hashes
    first: np.ndarray  # postings of term t: first[t]:first[t + 1]
    items: np.ndarray
    impacts: np.ndarray
    common: np.ndarray  # by term
    best: np.ndarray  # score of an item for itself
    held_back: np.ndarray  # what an item may get from common terms
    question: list[tuple[int, np.ndarray]]  # n and the n-grams
    answer: list[tuple[int, np.ndarray]]
    longest: int


def _overlap_grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct n-grams of a word sequence by their hashes."""
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x2545F4914F6CDD1D) + hashes[k:k + len(out)]
    return np.unique(out)


def _part(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    n = min(OVERLAP_WORDS, len(hashes))
    return n, _overlap_grams(hashes, n) if n else hashes


@dataclass(frozen=True)
class Statistics:
    """Of all items of a table: their number, words of one on average and at most, and the items that hold a term."""
    items: int
    mean_words: float
    longest: int
    holders: dict[int, int]  # by term hash


def build_index(item_ids: list[int], texts: list[str], whole: Statistics | None = None) -> Index:
    """An item's first half of words is its question, the rest its answer; items without words are never found.

    ``whole``: statistics of the table that the items are from; by default they are the table.
    """
    words = plain_words(pa.array(texts, pa.string()))
    hashes, owner, n = words.hashes(), words.text_of(), len(texts)
    terms, term = np.unique(hashes, return_inverse=True)
    pair, tf = np.unique(term * max(n, 1) + owner, return_counts=True)
    term, item = pair // max(n, 1), pair % max(n, 1)
    if whole is None:
        whole = Statistics(n, float(words.counts.mean()) if n else 1.0, int(words.counts.max(initial=1)),
                           dict(zip(terms.tolist(), np.bincount(term, minlength=len(terms)).tolist())))
    df = np.array([whole.holders[t] for t in terms.tolist()], np.float64)
    idf = np.log(1 + (whole.items - df + 0.5) / (df + 0.5))
    length = words.counts / max(whole.mean_words, 1e-9)
    impacts = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item]))
    best = np.bincount(item, weights=impacts, minlength=n)
    # terms become common from the lightest on while no item gets more than its share from them
    order = np.argsort(idf, kind="stable")
    held_back, common = np.zeros(n), np.zeros(len(terms), dtype=bool)
    first = np.searchsorted(term, np.arange(len(terms) + 1))
    for t in order:
        own = slice(first[t], first[t + 1])
        after = held_back[item[own]] + impacts[own]
        if (after > COMMON_SHARE * best[item[own]]).any():
            break
        held_back[item[own]] = after
        common[t] = True
    runs = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
    return Index(np.array(item_ids, np.int64), terms, first, item, impacts, common, best, held_back,
                 [_part(x[:(len(x) + 1) // 2]) for x in runs], [_part(x[(len(x) + 1) // 2:]) for x in runs],
                 whole.longest)


class Searcher:
    """Cursor tables of an index, made once in a task.

    Impacts are shares of what an item's rare terms must reach, so that one threshold, 1, holds for all items.
    """

    def __init__(self, index: Index):
        self.index = index
        self.gate = np.zeros(1 << _GATE_BITS, dtype=bool)
        self.gate[(index.terms[~index.common] >> np.uint64(64 - _GATE_BITS)).astype(np.int64)] = True
        self.n = max(len(index.best), 1)
        term = np.repeat(np.arange(len(index.terms)), np.diff(index.first))
        goal = SCORE_SHARE * index.best - index.held_back
        goal[index.best <= 0] = np.inf
        self.shares = index.impacts / goal[index.items]
        self.postings = term * self.n + index.items
        self.bound = np.zeros(len(index.terms))
        np.maximum.at(self.bound, term, self.shares)
        self.blocks = (self.n - 1) // BLOCK_ITEMS + 1
        key = term * self.blocks + index.items // BLOCK_ITEMS
        cut = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        self.block_key = key[cut]
        self.block_max = np.maximum.reduceat(self.shares, cut) if len(cut) else self.shares

    def _block_bound(self, term: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Largest share of each term in the block of an item, 0 without postings there."""
        key = term * self.blocks + item // BLOCK_ITEMS
        at = np.minimum(np.searchsorted(self.block_key, key), len(self.block_key) - 1)
        return np.where(self.block_key[at] == key, self.block_max[at], 0.0)

    def candidates(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, item) pairs whose rare terms alone may lift the item over its goal; pairs of input are distinct.

        Block-max WAND, a cursor for each pair of input; the cursors of all passages take their steps together. A step
        orders a passage's cursors by item and finds the pivot, the first item that the terms' bounds up to it allow.
        Where the bounds of the pivot's block fall short, the cursors before it leave the block or go to the next
        cursor's item. Else those behind the pivot go to it, or, all being there, it is scored. A passage without a
        pivot is done.
        """
        at, end = self.index.first[term], self.index.first[term + 1]
        found = []
        while len(passage):
            item = self.postings[at] - term * self.n
            order = np.lexsort((item, passage))
            passage, term, at, end, item = passage[order], term[order], at[order], end[order], item[order]
            head = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
            size = np.diff(np.append(head, len(passage)))
            reach = np.cumsum(self.bound[term])
            reach -= np.repeat(reach[head] - self.bound[term[head]], size)
            place = np.arange(len(passage))
            pivot = np.minimum.reduceat(np.where(reach + 1e-9 >= 1, place, len(place)), head)
            going = pivot < len(place)
            aim = item[pivot[going]]
            keep = np.repeat(going, size)
            passage, term, at, end, item = passage[keep], term[keep], at[keep], end[keep], item[keep]
            if not len(passage):
                break
            size = size[going]
            head = np.append(0, np.cumsum(size)[:-1])
            wide = np.repeat(aim, size)
            front = item <= wide
            ahead = np.minimum.reduceat(np.where(front, self.n, item), head)
            block = np.add.reduceat(np.where(front, self._block_bound(term, wide), 0.0), head)
            closed = block + 1e-9 < 1
            reached = ~closed & (item[head] == aim)
            score = np.add.reduceat(np.where(item == wide, self.shares[at], 0.0), head)
            hit = reached & (score + 1e-9 >= 1)
            found.append((passage[head[hit]], aim[hit]))
            target = np.where(closed, np.minimum((aim // BLOCK_ITEMS + 1) * BLOCK_ITEMS, ahead), aim + reached)
            target = np.repeat(target, size)
            moves = item < target
            at[moves] = np.searchsorted(self.postings, term[moves] * self.n + target[moves])
            live = at < end
            passage, term, at, end = passage[live], term[live], at[live], end[live]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def score(self, words: np.ndarray, item: int) -> float:
        """BM25 of one item for a passage, as a share of its score for itself."""
        place = np.searchsorted(self.index.terms, distinct := np.unique(words))
        place[place == len(self.index.terms)] = 0
        total = 0.0
        for t in place[self.index.terms[place] == distinct]:
            own = slice(self.index.first[t], self.index.first[t + 1])
            k = np.searchsorted(self.index.items[own], item)
            if k < own.stop - own.start and self.index.items[own][k] == item:
                total += self.index.impacts[own][k]
        return total / self.index.best[item]

    def search(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item, score share, overlaps) of each verified hit; the best passage of a text counts.

        Passages are twice as long as the longest item and start every half passage, so an item's copy lies in one.
        """
        index, step = self.index, self.index.longest
        at = np.flatnonzero(self.gate[(hashes >> np.uint64(64 - _GATE_BITS)).astype(np.int64)])
        term = np.searchsorted(index.terms, hashes[at])
        term[term == len(index.terms)] = 0
        real = (index.terms[term] == hashes[at]) & ~index.common[term] if len(index.terms) else np.zeros(len(at), bool)
        at, term = at[real], term[real]
        if not len(at):
            return
        text = np.searchsorted(first, at, side="right") - 1
        # passages are numbered through all texts: text t has the numbers from begin[t] on
        begin = np.append(0, np.cumsum(np.diff(first) // step + 2))
        number = begin[text] + (at - first[text]) // step + 1
        pairs = np.concatenate([number * len(index.terms) + term, (number - 1) * len(index.terms) + term])
        pairs = np.unique(pairs)
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        for passage, item in zip(*self.candidates(pairs // len(index.terms), pairs % len(index.terms))):
            t = int(np.searchsorted(begin, passage, side="right")) - 1
            low = first[t] + (passage - begin[t] - 1) * step
            inside = hashes[max(low, first[t]):min(low + 2 * step, first[t + 1])]
            share = self.score(inside, item)
            if share + 1e-12 < SCORE_SHARE:
                continue
            overlaps = [self._overlap(inside, part[item]) for part in (index.question, index.answer)]
            if min(overlaps) >= OVERLAP_SHARE and (share, *overlaps) > found.get((t, item), (0.0,)):
                found[t, item] = (share, *overlaps)
        for (t, item), values in found.items():
            yield (t, item, *values)

    @staticmethod
    def _overlap(inside: np.ndarray, part: tuple[int, np.ndarray]) -> float:
        """Share of the part's distinct n-grams that the passage has; an empty part is no obstacle."""
        n, grams = part
        return float(np.isin(grams, _overlap_grams(inside, n)).mean()) if n and len(inside) >= n else float(not n)


def _ranges(first: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places first[k]:first[k + 1] for k in ``of``, and which entry of ``of`` each is for."""
    size = first[of + 1] - first[of]
    which = np.repeat(np.arange(len(of)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + first[of][which], which


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(shared.value)
        for batch in batches:
            for piece in slices(batch):
                words = plain_words(piece.column(1))
                rows = list(searcher.search(words.hashes(), words.first))
                ids = piece.column(0).to_pylist()
                yield pa.RecordBatch.from_pydict(dict(zip(_HITS.names, (
                    [ids[r[0]] for r in rows], [int(shared.value.item_ids[r[1]]) for r in rows],
                    *([float(r[k]) for r in rows] for k in (2, 3, 4))))), schema=_HITS)
    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words and the distinct terms of each item."""
    for batch in batches:
        for piece in slices(batch):
            words = plain_words(piece.column(1))
            terms = [np.unique(x).view(np.int64) for x in np.split(words.hashes(), words.first[1:-1])]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(words.counts.astype(np.int64)), pa.array(terms, pa.list_(pa.int64()))],
                names=["part", "n_words", "terms"])


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, score_share, question_overlap, answer_overlap``: a row for each item a document holds.

    Words are lower-cased, punctuation parts them. Document frequencies, mean length and passage length are those of all items.
    Null or empty texts and items match nothing; a null doc_id is reported as null and items with a null id are left out;
    repeated rows and repeated items are reported each. Without documents or items there are no rows. Each index is
    broadcast with its own terms' frequencies, and its items are counted first: it has about ``INDEX_ITEMS`` of them.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where(
        "item_id IS NOT NULL AND text IS NOT NULL")
    groups = max(1, -(-known.count() // INDEX_ITEMS))
    known = known.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)))
    terms = write_out(known.select("part", "text").mapInArrow(_item_terms, "part long, n_words long, terms array<long>"), "item_terms")
    sizes = terms.agg(F.count("*").alias("items"), F.avg("n_words").alias("mean_words"), F.max("n_words").alias("longest")).first()
    each = terms.select("part", F.explode("terms").alias("term"))
    holders = write_out(each.groupBy("term").agg(F.count("*").alias("holders")), "item_holders")
    out = None
    for g in range(groups):
        rows = known.where(F.col("part") == g).orderBy("item_id", "text").collect()
        own = holders.join(each.where(F.col("part") == g).select("term"), "term", "left_semi").collect()
        whole = Statistics(sizes["items"], sizes["mean_words"] or 1.0, max(sizes["longest"] or 1, 1),
                           {r["term"] % (1 << 64): r["holders"] for r in own})
        index = spark.sparkContext.broadcast(build_index([r["item_id"] for r in rows], [r["text"] for r in rows], whole))
        hits = source.mapInArrow(_search(index), _HITS_DDL)
        out = hits if out is None else out.unionByName(hits)
    return out
