"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character n-grams (1 to 3 code points, lower-cased, digits and punctuation as blanks),
with sublinear term frequency times inverse document frequency, normalised. Each language has a few centroids from
spherical k-means over labelled texts; a text gets the language of its centroid with the largest cosine. A text
that is further from its centroid than labelled texts of that language and of like length are is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrydesk.llm.words import mix, slices, text_bytes

#: Hashed n-gram features.
DIMENSIONS = 4096
#: Labelled texts that a model is fitted on, at most, of each language: the bound of the training sample.
SAMPLE_PER_LANGUAGE = 1000
CENTROIDS = 4
ROUNDS = 10
#: A text is rejected when its cosine is below this share of a low quantile of the cosines that labelled texts of its
#: language and length have with centroids fitted without them.
REJECT_SHARE, REJECT_QUANTILE = 0.75, 0.01
#: Lengths, counted in n-grams, are alike within one power of ``LENGTH_STEP``; the last class has no upper end.
LENGTH_STEP, LENGTHS = 4, 9
#: So many labelled texts at least calibrate one cut, if need be of other languages or from the classes beside it.
CALIBRATORS = 20

UNDETERMINED = "und"
_COUNT_ROWS = 256


def _letters() -> np.ndarray:
    """Code point to its lower-case letter, 0 for what is no letter; code points above 0xFFFF map to 0."""
    out = np.zeros(0x10000, dtype=np.uint32)
    for code in range(0x10000):
        if not 0xD800 <= code < 0xE000 and (c := chr(code)).isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


_LETTER = _letters()


def ngram_counts(column: pa.Array) -> Iterator[np.ndarray]:
    """Blocks of rows of n-gram counts, one row for each text."""
    for at in range(0, len(column), _COUNT_ROWS):
        data, offsets = text_bytes(column.slice(at, _COUNT_ROWS))
        n = len(offsets) - 1
        codes = np.frombuffer(data.tobytes().decode(errors="replace").encode("utf-32-le"), np.uint32)
        heads = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        starts = heads[offsets]
        letters = np.where(codes < 0x10000, _LETTER[np.minimum(codes, 0xFFFF)], 0)
        letters[(codes >= 0x10000)] = 0
        # one blank between words: runs of non-letters shrink to one, and a blank ends every text
        letters = np.insert(letters, starts[1:], 0)
        text = np.repeat(np.arange(n), np.diff(starts) + 1)
        keep = (letters != 0) | np.append(True, letters[:-1] != 0)
        letters, text = letters[keep].astype(np.uint64), text[keep]
        counts = np.zeros((n, DIMENSIONS), dtype=np.float32)
        if not len(letters):
            yield counts
            continue
        gram, size = letters, 1
        flat = np.zeros(n * DIMENSIONS, dtype=np.int64)
        while size <= 3:
            whole = text[:len(gram)] == text[size - 1:]
            solid = whole & (gram[:len(whole)] != 0)
            bucket = (mix(gram[solid] * np.uint64(8) + np.uint64(size)) % np.uint64(DIMENSIONS)).astype(np.int64)
            flat += np.bincount(text[:len(gram)][solid] * DIMENSIONS + bucket, minlength=len(flat))
            size += 1
            if len(letters) < size:
                break
            gram = gram[:len(letters) - size + 1] * np.uint64(0x110000) + letters[size - 1:]
        yield flat.reshape(n, DIMENSIONS).astype(np.float32)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(counts) * idf
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.maximum(norm, 1e-12)


#: A feature and its count or weight, as they travel.
_ENTRY = np.dtype([("at", "<u2"), ("n", "<f4")])


class Texts:
    """The sample as sparse vectors of unit length; a copy is only ever made of a few rows."""

    def __init__(self, begin: np.ndarray, entries: np.ndarray):
        self.begin, self.at, sizes = begin, entries["at"], np.diff(begin)
        seen = np.bincount(self.at, minlength=DIMENSIONS)
        self.idf = (np.log((1 + len(sizes)) / (1 + seen)) + 1).astype(np.float32)
        self.length = length_class(np.add.reduceat(np.append(entries["n"], 0), begin[:-1]) * (sizes > 0))
        self.value = np.log1p(entries["n"])
        self.value *= self.idf[self.at]
        norm = np.sqrt(np.add.reduceat(np.append(self.value * self.value, 0), begin[:-1]))
        self.value /= np.repeat(np.maximum(norm, 1e-12), sizes)

    def _some(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = self.begin[rows + 1] - self.begin[rows]
        entry = np.arange(sizes.sum()) + np.repeat(self.begin[rows] - np.cumsum(sizes) + sizes, sizes)
        return sizes, self.at[entry], self.value[entry]

    def cosines(self, rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
        out, turned = np.zeros((len(rows), len(centres)), np.float32), np.ascontiguousarray(centres.T)
        for k in range(0, len(rows), _COUNT_ROWS):
            sizes, at, value = self._some(rows[k:k + _COUNT_ROWS])
            full = np.flatnonzero(sizes)
            if len(full):
                out[k + full] = np.add.reduceat(turned[at] * value[:, None], (np.cumsum(sizes) - sizes)[full], axis=0)
        return out

    def total(self, rows: np.ndarray) -> np.ndarray:
        _, at, value = self._some(rows)
        return np.bincount(at, value, minlength=DIMENSIONS).astype(np.float32)


@dataclass(frozen=True)
class CentroidModel:
    """Centroids of unit length with their languages; ``reject_below`` (centroid, length class) has the least cosines
    that are no outliers."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    reject_below: np.ndarray


def _spherical_kmeans(texts: Texts, rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids from far-apart starts; ties go to the lower index, an empty cluster keeps its centre."""
    rng = np.random.default_rng(seed)
    centres = [texts.total(rows[[rng.integers(len(rows))]])]
    while len(centres) < min(k, len(rows)):
        centres.append(texts.total(rows[[np.argmin(texts.cosines(rows, np.stack(centres)).max(axis=1))]]))
    centres = np.stack(centres)
    for _ in range(ROUNDS):
        near = texts.cosines(rows, centres).argmax(axis=1)
        for c in range(len(centres)):
            if (total := texts.total(rows[near == c])).any():
                centres[c] = total / np.linalg.norm(total)
    return centres


def fit_centroids(labelled: DataFrame, seed: int = 5, per_language: int = SAMPLE_PER_LANGUAGE, k: int = CENTROIDS,
                  label_col: str = "lang", text_col: str = "text") -> CentroidModel:
    """Fit on about ``per_language`` labelled texts of each language, chosen by a hash of the text.

    The sample has at most twice that number for each language. Equal texts count once; rows with a null label or text, or
    without a letter, teach nothing. Without any labelled text the model has no language and rejects all.
    """
    wanted = labelled.select(F.col(label_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL").where(has_letter(F.col("text")))
    order = F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(1 << 30))
    # copies count once here as in the sample
    sizes = {r["lang"]: r["n"] for r in wanted.groupBy("lang").agg(F.count_distinct(order).alias("n")).collect()}
    if not sizes:
        return CentroidModel(np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), [], np.zeros((0, LENGTHS)))
    # the cut by hash keeps about the bound of each language, and the limit makes it one
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_language / n)).otherwise(share)
    thin = wanted.where(order < share * (1 << 30)).select("lang", order.alias("order"), "text").dropDuplicates(
        ["lang", "order"])
    features = "lang string, order long, counts binary"
    sample = thin.mapInArrow(_features, features).orderBy("order", "lang").limit(2 * per_language * len(sizes)).toArrow()
    if not sample.num_rows:
        sample = wanted.select("lang", order.alias("order"), "text").orderBy("order").limit(per_language).mapInArrow(
            _features, features).toArrow()
    cells = sample.column("counts").combine_chunks().cast(pa.large_binary())
    cells = cells if isinstance(cells, pa.Array) else cells.chunk(0)
    offsets = np.frombuffer(cells.buffers()[1], np.int64)[cells.offset:cells.offset + len(cells) + 1]
    entries = np.frombuffer(cells.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(_ENTRY)
    texts = Texts((offsets - offsets[0]) // _ENTRY.itemsize, entries)
    lang = np.array(sample.column("lang").to_pylist())
    del sample, cells, entries
    names, centres = _centroids(texts, np.arange(len(lang)), lang, k, seed)
    return CentroidModel(texts.idf, centres, names, _cuts(texts, lang, names, k, seed))


def _centroids(texts: Texts, rows: np.ndarray, lang: np.ndarray, k: int, seed: int) -> tuple[list[str], np.ndarray]:
    names, centres = [], []
    for name in sorted(set(lang[rows].tolist())):
        own = _spherical_kmeans(texts, rows[lang[rows] == name], k, seed)
        centres.append(own)
        names += [name] * len(own)
    return names, np.concatenate(centres).astype(np.float32)


def length_class(size: np.ndarray) -> np.ndarray:
    """By the number of n-grams."""
    size = np.maximum(size, 1)
    return np.minimum(np.log(size) / np.log(LENGTH_STEP) + 1e-6, LENGTHS - 1).astype(np.int64)


def _cuts(texts: Texts, lang: np.ndarray, names: list[str], k: int, seed: int) -> np.ndarray:
    """The least cosine that is no outlier for each centroid and length class.

    Each half of a language's texts is judged by centroids of the other half, as texts lie too near to their own. Where
    a language has few texts of a class, those of all languages count; where all have few, the class is filled up with
    shorter texts, whose cosines are no larger, then with longer ones, whose cosines shrink with the root of the length.
    """
    half = np.zeros(len(lang), dtype=np.int64)
    for name in set(lang.tolist()):
        half[lang == name] = np.arange((lang == name).sum()) % 2
    found, cosine, size = [], [], []
    for h in (0, 1):
        if not (half != h).any():
            continue
        fitted, centres = _centroids(texts, np.flatnonzero(half != h), lang, k, seed)
        own = np.flatnonzero((half == h) & np.isin(lang, fitted))
        near = texts.cosines(own, centres)
        found += [fitted[b] for b in near.argmax(axis=1)]
        cosine.append(near.max(axis=1))
        size.append(texts.length[own])
    if not found:
        return np.zeros((len(names), LENGTHS))
    found, cosine, size = np.array(found), np.concatenate(cosine), np.concatenate(size)

    def cut(name: str, at: int) -> float:
        used = cosine[(size == at) & (found == name)]
        for c in [at, *range(at - 1, -1, -1), *range(at + 1, LENGTHS)]:
            if len(used) >= CALIBRATORS:
                break
            alike = cosine[size == c] * float(LENGTH_STEP) ** (-max(c - at, 0) / 2)
            used = alike if c == at else np.append(used, alike)
        return REJECT_SHARE * float(np.quantile(used, REJECT_QUANTILE))
    known = {name: [cut(name, at) for at in range(LENGTHS)] for name in set(names)}
    return np.array([known[name] for name in names])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            packed = [_sparse(row) for block in ngram_counts(piece.column(2)) for row in block]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(packed, pa.binary())],
                                             names=["lang", "order", "counts"])


def _sparse(row: np.ndarray) -> bytes:
    out = np.zeros(len(at := np.flatnonzero(row)), _ENTRY)
    out["at"], out["n"] = at, row[at]
    return out.tobytes()


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _scorer(model, names_out: list[str], text_col: str):
    text_at = names_out.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            for piece in slices(batch, text_col):
                names, scores, cuts = [], [], []
                for counts in ngram_counts(piece.column(text_at)):
                    if not known.languages:
                        names += [UNDETERMINED] * len(counts)
                        scores += [0.0] * len(counts)
                        cuts += [2.0] * len(counts)
                        continue
                    cosine = _vectors(counts, known.idf) @ known.centroids.T
                    best = np.argmax(cosine, axis=1)
                    names += [known.languages[b] for b in best]
                    scores += np.clip(cosine[np.arange(len(best)), best], 0, 1).tolist()
                    cuts += known.reject_below[best, length_class(counts.sum(axis=1))].tolist()
                lettered = piece.column(piece.num_columns - 1).to_numpy(zero_copy_only=False)
                scores = np.where(lettered, np.array(scores, dtype=np.float64), 0.0)
                names = [name if x else UNDETERMINED for name, x in zip(names, lettered)]
                kept = piece.columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores), pa.array(
                    ~lettered | (scores < np.array(cuts, dtype=np.float64)))], names=names_out)
    return run


def with_language(docs: DataFrame, model: CentroidModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected`` of whole texts, row by row: the nearest centroid's language and its cosine.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; other texts further away than
    ``model.reject_below`` has for their length keep their nearest language and are rejected. Ties go to the first language
    by name. Repeated rows are scored each; columns of the three names give way; an empty table gives none. The model is
    broadcast: its size is ``DIMENSIONS`` times the centroids, whatever the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.drop("lang_pred", "score", "rejected").withColumn(text_col, F.col(text_col).cast("string"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields]
    asked = plain.select("*", has_letter(F.col(text_col)).alias("_lid_lettered"))
    return asked.mapInArrow(_scorer(shared, [*plain.columns, "lang_pred", "score", "rejected"], text_col), ", ".join([*kinds, "lang_pred string", "score double", "rejected boolean"]))


def identify_languages(docs: DataFrame, model: CentroidModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of ``with_language``. Null ids stay null."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return with_language(plain, model).drop("text")
