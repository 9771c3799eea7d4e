"""Similarity of one bounded block of targets to one bounded block of masters.

These helpers run inside Spark tasks on Arrow tables; which rows meet in a task is decided by
`knn.py`. They keep the k best masters per target and never return other pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.functions.text import is_blank, normalize_text

TARGET_KEY = "target_key"
MASTER_KEY = "master_key"
SCORE = "score"
RANK = "rank"
# Targets may carry a score that their k-th match is known to reach.
FLOOR = "_floor"
DECIMALS = 6

# Bytes of targets compared at a time, and the bound of the matrices held for that, in cells.
_SLICE_BYTES = 16 * 2**20
_CELLS = 4_000_000
_DENSE_CELLS = 16_000_000

# Texts of so many distinct tokens on average are compared by sketches first. A sketch has a place for each of the heaviest
# tokens and places that all others share, few in the first sketch and more in the second; so many texts of either side are
# sketched at a time.
_LONG_TEXT = 32
_OWN_PLACES, _SHARED_PLACES = 256, (1_280, 3_840)
_SKETCHED_TARGETS, _SKETCHED_MASTERS = 512, 8_192

# A text of so many times the tokens of the other is searched for those of the other, not read whole.
_SEARCHED = 8

# Bytes of texts whose tokens are counted at a time.
_COUNTED_BYTES = 4 * 2**20

# What rounding to DECIMALS can make of a score, and more than single precision can take off a bound.
_ROUNDED = 1e-6
_SINGLE = 3e-4

# Vectors of equal hash compared at a time.
_ROWS_COMPARED = 16_384


def vector_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as a double matrix, without a Python object per row."""
    return raw_matrix(column).astype(np.float64)


def raw_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as a matrix of their own type."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(array), -1) if len(array) else np.zeros((0, 0))


class DenseScorer:
    """Inner product of equally long vectors; a zero vector matches nothing."""

    column = "vector"

    def ready(self, df: DataFrame) -> DataFrame:
        """Rows that can match at all, in the form that is compared."""
        return df.where(F.size("vector") > 0)

    def index(self, masters: pa.Table) -> "_DenseIndex":
        return _DenseIndex(raw_matrix(masters[self.column]))


def _copy_ranks(group: np.ndarray) -> np.ndarray:
    """For each row, how many rows before it are of the same group."""
    order = np.argsort(group, kind="stable")
    ordered = group[order]
    ranks = np.empty(len(group), np.int64)
    ranks[order] = np.arange(len(group)) - np.searchsorted(ordered, ordered)
    return ranks


def _equal_rows(matrix: np.ndarray) -> np.ndarray:
    """A number for each row that equal rows share.

    Rows are ordered by a hash and compared with the row before. Different rows of one hash are told apart; equal ones between
    which such a row comes get several numbers.
    """
    if not matrix.size:
        return np.zeros(len(matrix), np.int64)
    bits = np.ascontiguousarray(matrix).view(np.dtype(f"u{matrix.itemsize}"))
    hashes = np.zeros(len(matrix), np.uint64)
    for factor, column in zip(np.random.default_rng(7).integers(1, 2**63, bits.shape[1], np.uint64), bits.T):
        hashes = (hashes ^ (hashes >> np.uint64(29))) + (column.astype(np.uint64) + np.uint64(1)) * (2 * factor + np.uint64(1))
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    new = np.ones(len(matrix), bool)
    for start in range(0, len(same), _ROWS_COMPARED):
        piece = same[start : start + _ROWS_COMPARED]
        new[piece + 1] = (bits[order[piece]] != bits[order[piece + 1]]).any(axis=1)
    numbers = np.empty(len(matrix), np.int64)
    numbers[order] = np.cumsum(new)
    return numbers


class _DenseIndex:
    """Vectors as they were given; they turn into doubles a tile at a time."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.empty = ~matrix.any(axis=1)
        self.copy_rank = _copy_ranks(_equal_rows(matrix))

    def search(self, targets: pa.Table, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _search_tiles(self.scores(targets, k), k, floors)

    def scores(self, targets: pa.Table, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        return self.compare(vector_matrix(targets[DenseScorer.column]), k)

    def compare(self, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Masters come in the order of their keys, so of equal vectors only the first k can be among the k best."""
        columns = np.flatnonzero((self.copy_rank < k) & ~self.empty)
        width = max(1, min(len(columns), 8192))
        height = max(1, _CELLS // width)
        for left in range(0, len(columns), width):
            chosen = columns[left : left + width]
            masters = self.matrix[chosen].astype(np.float64).T
            for top in range(0, len(queries), height):
                part = queries[top : top + height]
                found = part @ masters
                found[~part.any(axis=1)] = -np.inf
                yield top, chosen, found


def encode_vectors(matrix: np.ndarray) -> list[bytes]:
    """One byte per component, after the step between two codes and the length of what the code leaves out."""
    steps = np.abs(matrix).max(axis=1, initial=0.0) / 127
    steps[steps == 0] = 1.0
    codes = np.rint(matrix / steps[:, None]).astype(np.int8)
    lost = np.linalg.norm(matrix - codes * steps[:, None], axis=1)
    heads = np.column_stack([steps, lost]).astype("<f8")
    return [head.tobytes() + code.tobytes() for head, code in zip(heads, codes)]


def decode_vectors(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The vectors that the codes stand for, and the length of what is lost of each."""
    if not len(column):
        return np.zeros((0, 0)), np.zeros(0)
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    heads = np.ascontiguousarray(raw[:, :16]).view("<f8")
    return np.ascontiguousarray(raw[:, 16:]).view(np.int8) * heads[:, :1], heads[:, 1]


class CodeScorer:
    """Upper bound of the inner product of two vectors of which the codes are known."""

    column = "code"

    def ready(self, df: DataFrame) -> DataFrame:
        return df

    def index(self, masters: pa.Table) -> "_CodeIndex":
        return _CodeIndex(masters[self.column])


class _CodeIndex(_DenseIndex):
    """With q = q' + e and m = m' + f, qm exceeds q'm' by at most |e| (|m'| + |f|) + |q'| |f|.

    The lengths are two more components, so one matrix product gives the bound.
    """

    def __init__(self, column: pa.ChunkedArray | pa.Array):
        matrix, lost = decode_vectors(column)
        super().__init__(np.column_stack([matrix, np.linalg.norm(matrix, axis=1) + lost, lost]))
        self.empty = ~matrix.any(axis=1)

    def scores(self, targets: pa.Table, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        queries, lost = decode_vectors(targets[CodeScorer.column])
        empty = ~queries.any(axis=1)
        for top, chosen, found in self.compare(np.column_stack([queries, lost, np.linalg.norm(queries, axis=1)]), k):
            found += _ROUNDED  # no bound falls below its score by the rounding of either
            found[empty[top : top + len(found)]] = -np.inf
            yield top, chosen, found


class LexicalScorer:
    """Cosine of the counts of lower-cased, blank-separated tokens; an empty text matches nothing."""

    column = "text"

    def ready(self, df: DataFrame) -> DataFrame:
        # The filter looks at the raw text, so that texts are not normalised twice.
        filled = df.where(~is_blank(F.col("text")))
        return filled.withColumn("text", F.lower(normalize_text(F.col("text"))))

    def index(self, masters: pa.Table) -> "_LexicalIndex":
        return _LexicalIndex(CountedTexts.of(masters[self.column]))


def _distinct(column: pa.ChunkedArray | pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct texts in order of first appearance, and the text number of each row."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    coded = array.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)


def token_counts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary and the (text, token, unit-length weight) triples, ordered by text."""
    vocabulary, row, token, count = _token_counts(texts)
    return vocabulary, row, token, _weights(row, count, len(texts))


def _weights(row: np.ndarray, count: np.ndarray, texts: int) -> np.ndarray:
    return count / np.sqrt(np.bincount(row, weights=count.astype(np.float64) ** 2, minlength=texts))[row]


def _token_counts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary and the (text, token, count) triples, ordered by text.

    Tokens are split from a few megabytes of texts at a time, as they take several times the memory of their texts.
    """
    step = max(1, int(len(texts) * min(1.0, _COUNTED_BYTES / max(1, texts.nbytes))))
    if step >= len(texts):
        return _count_tokens(texts)
    parts = [_count_tokens(texts.slice(at, step)) for at in range(0, len(texts), step)]
    coded = pa.chunked_array([part[0] for part in parts]).combine_chunks().dictionary_encode()
    ends = np.cumsum([0, *(len(part[0]) for part in parts)])
    codes = coded.indices.to_numpy().astype(np.int64)
    rows = np.concatenate([part[1] + number * step for number, part in enumerate(parts)])
    tokens = np.concatenate([codes[end:][part[2]] for end, part in zip(ends, parts)])
    return coded.dictionary, rows, tokens, np.concatenate([part[3] for part in parts])


def _count_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    lists = pc.split_pattern(texts, " ")
    tokens, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    filled = pc.not_equal(tokens, "")
    tokens, rows = tokens.filter(filled), rows.filter(filled).to_numpy()
    coded = tokens.dictionary_encode()
    size = max(1, len(coded.dictionary))
    cells, counts = np.unique(
        rows.astype(np.int64) * size + coded.indices.to_numpy(), return_counts=True
    )
    return coded.dictionary, cells // size, cells % size, counts


class CountedTexts:
    """The distinct texts of a column as token counts, and the text of each row."""

    def __init__(self, text_of_row: np.ndarray, texts: int, vocabulary: pa.Array, row, token, count):
        self.text_of_row, self.texts, self.vocabulary = text_of_row, texts, vocabulary
        self.row, self.token, self.count = row, token, count

    @classmethod
    def of(cls, column: pa.ChunkedArray | pa.Array) -> "CountedTexts":
        texts, text_of_row = _distinct(column)
        return cls(text_of_row, len(texts), *_token_counts(texts))

    def weights(self) -> np.ndarray:
        return _weights(self.row, self.count, self.texts)


def pack_texts(rows: pa.Table, key: str) -> bytes:
    """Keys and counted texts of a block as one value, so that tokens are counted once however many blocks it meets."""
    rows = rows.sort_by(key)
    counted = CountedTexts.of(rows[LexicalScorer.column])
    lengths = np.bincount(counted.row, minlength=counted.texts)
    columns = {"key": rows[key].combine_chunks(), "text_of_row": counted.text_of_row, "vocabulary": counted.vocabulary}
    columns |= {name: x.astype(np.int32) for name, x in (("lengths", lengths), ("token", counted.token), ("count", counted.count))}
    values = [pa.array(x) for x in columns.values()]
    batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(x)], x) for x in values], list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_texts(packed: pa.Buffer) -> tuple[pa.Array, CountedTexts]:
    """Keys in their order and counted texts of a block."""
    batch = pa.ipc.open_stream(packed).read_next_batch()
    keys, text_of_row, vocabulary, lengths, token, count = (column.flatten() for column in batch.columns)
    row = np.repeat(np.arange(len(lengths)), lengths.to_numpy())
    return keys, CountedTexts(text_of_row.to_numpy(), len(lengths), vocabulary, row, token.to_numpy(), count.to_numpy())


def _slices(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every slice, one slice after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)


def prefix_buckets(
    column: pa.Array, frequent: pa.Array, threshold: float, buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the tokens by which a text meets every text of at least `threshold` cosine.

    Tokens are ordered alike for all texts: those outside `frequent` alphabetically, then `frequent` as
    listed. The last tokens of a text may be left out while their norm is below the threshold: a text
    that shares none of the others has a smaller cosine. Any order is right; one with rare tokens first
    makes the buckets small.
    """
    texts, text_of_row = _distinct(column)
    vocabulary, row, token, weight = token_counts(texts)
    late = pc.index_in(vocabulary, value_set=frequent).fill_null(-1).to_numpy()
    alphabetical = np.empty(len(vocabulary), np.int64)
    alphabetical[pc.sort_indices(vocabulary).to_numpy()] = np.arange(len(vocabulary))
    order = np.lexsort((-alphabetical[token], -late[token], row))
    row, token, energy = row[order], token[order], np.cumsum(weight[order] ** 2)
    first = np.searchsorted(row, row)
    tail = energy - np.where(first > 0, energy[first - 1], 0.0)
    kept = tail >= max(0.0, threshold - 1e-5) ** 2 - 1e-9
    hashed = pd.util.hash_array(vocabulary.to_numpy(zero_copy_only=False), categorize=False)
    places = (hashed % np.uint64(buckets)).astype(np.int64)
    cells = np.unique(row[kept] * buckets + places[token[kept]])
    bounds = np.searchsorted(cells, np.arange(len(texts) + 1) * buckets)
    counts = np.diff(bounds)[text_of_row]
    at = _slices(bounds[text_of_row], counts)
    return np.repeat(np.arange(len(text_of_row)), counts), cells[at] % buckets


class _LexicalIndex:
    def __init__(self, counted: CountedTexts):
        self.text_of_row, self.texts, self.vocabulary = counted.text_of_row, counted.texts, counted.vocabulary
        self.copy_rank = _copy_ranks(self.text_of_row)
        row, token, weight, self.sketches = counted.row, counted.token, counted.weights(), None
        if len(row) >= _LONG_TEXT * max(1, self.texts):
            self.sketches = _Sketches(row, token, weight, self.texts, len(self.vocabulary))
            return
        order = np.argsort(token, kind="stable")
        self.rows, self.weights = row[order], weight[order]
        self.bounds = np.searchsorted(token[order], np.arange(len(self.vocabulary) + 1))
        self._densify_frequent()

    def _densify_frequent(self):
        """Tokens of more than a twentieth of the texts as a dense matrix, for a matrix product.

        They make up most of the postings; the others stay in the inverted lists.
        """
        frequency = np.diff(self.bounds)
        room = _DENSE_CELLS // max(1, self.texts)
        frequent = np.flatnonzero(frequency > self.texts / 20)
        frequent = frequent[np.argsort(-frequency[frequent], kind="stable")][:room]
        self.place = np.full(len(self.vocabulary) + 1, -1)
        self.place[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), self.texts))
        for at, token in enumerate(frequent):
            postings = slice(self.bounds[token], self.bounds[token + 1])
            self.dense[at, self.rows[postings]] = self.weights[postings]

    def _known(self, targets: CountedTexts):
        """(text, token of the masters, weight) of the tokens that the targets share with the masters."""
        known = pc.index_in(targets.vocabulary, value_set=self.vocabulary).fill_null(-1).to_numpy()[targets.token]
        shared = known >= 0
        return targets.row[shared], known[shared], targets.weights()[shared]

    def search(self, targets: pa.Table, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.search_counted(CountedTexts.of(targets[LexicalScorer.column]), k, floors)

    def search_counted(self, targets: CountedTexts, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.sketches:
            return _search_tiles(self.scores(targets, k), k, floors)
        least = np.full(targets.texts, np.inf)
        np.minimum.at(least, targets.text_of_row, floors)
        text, found, score = self.sketches.search(*self._known(targets), k, least)
        # Distinct texts are spread to the first k masters and to all targets that carry them.
        first = np.flatnonzero(self.copy_rank < k)
        at, columns = _spread_to(found, self.text_of_row[first])
        text, score, columns = text[at], score[at], first[columns]
        at, rows = _spread_to(text, targets.text_of_row)
        return rows, columns[at], score[at]

    def scores(self, targets: CountedTexts, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        texts, text_of_row = targets.texts, targets.text_of_row
        row, known, weight = self._known(targets)
        place = self.place[known]
        lengths = np.where(place >= 0, 0, self.bounds[known + 1] - self.bounds[known])
        text_bounds = np.searchsorted(row, np.arange(texts + 1))
        rows_by_text = np.argsort(text_of_row, kind="stable")
        row_bounds = np.searchsorted(text_of_row[rows_by_text], np.arange(texts + 1))
        height = max(1, _CELLS // max(1, self.texts))
        for top in range(0, texts, height):
            end = min(top + height, texts)
            lo, hi = text_bounds[top], text_bounds[end]
            frequent = lo + np.flatnonzero(place[lo:hi] >= 0)
            query = np.zeros((end - top, len(self.dense)))
            query[row[frequent] - top, place[frequent]] = weight[frequent]
            found = (query @ self.dense).ravel()
            # Postings of the whole batch at once, cut where they would outgrow the score matrix.
            for a, b in _pieces(lengths[lo:hi], _CELLS):
                a, b = lo + a, lo + b
                at = _slices(self.bounds[known[a:b]], lengths[a:b])
                cell = np.repeat((row[a:b] - top) * self.texts, lengths[a:b]) + self.rows[at]
                product = np.repeat(weight[a:b], lengths[a:b]) * self.weights[at]
                found += np.bincount(cell, weights=product, minlength=len(found))
            found = np.round(found.reshape(end - top, self.texts), DECIMALS)
            yield from self._per_row(found, top, end, rows_by_text, row_bounds, k)

    def _per_row(self, found, top, end, rows_by_text, row_bounds, k):
        """Scores of distinct texts spread to the first k rows that carry them.

        Masters come in the order of their keys, so no later copy can be among the k best.
        """
        columns = np.flatnonzero(self.copy_rank < k)
        wide = found[:, self.text_of_row[columns]]
        rows = rows_by_text[row_bounds[top] : row_bounds[end]]
        text = np.repeat(np.arange(end - top), np.diff(row_bounds[top : end + 1]))
        height = max(1, _CELLS // max(1, wide.shape[1]))
        for start in range(0, len(rows), height):
            yield rows[start : start + height], columns, wide[text[start : start + height]]


class _Sketches:
    """Exact search among long texts that compares few pairs whole.

    A sketch keeps the weights of the heaviest tokens apart and, of all others, the norm of those that share a place. By
    the inequality of Cauchy and Schwarz the product of two sketches is at least that of the texts, so a pair whose sketches
    stay below what the target has found already, or below the threshold, is left out without changing the result. Sketches
    are made for some texts at a time and compared by a matrix product; pairs left are compared by wider sketches, and what
    is left then, most promising first, is scored on all tokens.
    """

    def __init__(self, row, token, weight, texts: int, vocabulary: int):
        self.texts, self.vocabulary = texts, vocabulary
        by_weight = np.argsort(-np.bincount(token, weights=weight**2, minlength=vocabulary), kind="stable")
        # Tokens are numbered by weight, so that those met most often lie side by side.
        self.rank = np.empty(vocabulary, np.int64)
        self.rank[by_weight] = rank = np.arange(vocabulary)
        self.starts, self.tokens, self.weights = self._by_rank(row, token, weight, texts)
        self.places = [np.where(rank < _OWN_PLACES, rank, _OWN_PLACES + rank % shared) for shared in _SHARED_PLACES]

    def _by_rank(self, row, token, weight, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each text starts, and tokens and weights with the tokens of a text in the order of their numbers."""
        token = self.rank[token]
        order = np.argsort(row * self.vocabulary + token)
        return np.searchsorted(row, np.arange(texts + 1)), token[order], weight[order]

    def _sketch(self, wide: int, starts, tokens, weights, first: int, last: int) -> np.ndarray:
        places, width = self.places[wide], _OWN_PLACES + _SHARED_PLACES[wide]
        sketch = np.empty((last - first, width), np.float32)
        for a in range(first, last, 256):
            b = min(a + 256, last)
            piece = slice(starts[a], starts[b])
            cells = np.repeat(np.arange(b - a) * width, np.diff(starts[a : b + 1])) + places[tokens[piece]]
            squares = np.bincount(cells, weights=weights[piece] ** 2, minlength=(b - a) * width)
            np.sqrt(squares.reshape(b - a, width), out=sketch[a - first : b - first], casting="same_kind")
        return sketch

    def search(self, row, token, weight, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(target text, master text, score) of at least the k best masters that reach the floor of a target."""
        targets = self._by_rank(row, token, weight, len(floors))
        masters = self.starts, self.tokens, self.weights
        spread = np.zeros(self.vocabulary)
        kept = {}
        for left in range(0, self.texts, _SKETCHED_MASTERS):
            right = min(left + _SKETCHED_MASTERS, self.texts)
            narrow, wide = (self._sketch(i, *masters, left, right) for i in range(2))
            for top in range(0, len(floors), _SKETCHED_TARGETS):
                end = min(top + _SKETCHED_TARGETS, len(floors))
                bounds = self._sketch(0, *targets, top, end) @ narrow.T
                queries = self._sketch(1, *targets, top, end)
                for at in np.flatnonzero(bounds.max(axis=1) >= floors[top:end] - _SINGLE):
                    mine = slice(targets[0][top + at], targets[0][top + at + 1])
                    query = targets[1][mine], targets[2][mine], spread
                    spread[query[0]] = query[1]
                    floor, found = floors[top + at], kept.get(top + at, (np.zeros(0, np.int64), np.zeros(0)))
                    near = np.flatnonzero(bounds[at] >= floor - _SINGLE)
                    if len(near) > 4 * k + 12:
                        # A look at the most promising ones raises the floor for the others.
                        order = np.argpartition(-bounds[at, near], 2 * k + 6)
                        first, near = near[order[: 2 * k + 6]], near[order[2 * k + 6 :]]
                        floor, found = self._look(first + left, _products(wide, first, queries[at]), query, k, floor, *found)
                        near = near[bounds[at, near] >= floor - _SINGLE]
                    floors[top + at], kept[top + at] = self._look(near + left, _products(wide, near, queries[at]), query, k, floor, *found)
                    spread[query[0]] = 0.0
        rows = np.repeat(np.array(list(kept), np.int64), [len(column) for column, _ in kept.values()])
        columns, scores = ([np.zeros(0, kind), *parts] for kind, parts in zip((np.int64, float), zip(*kept.values()) if kept else ((), ())))
        return rows, np.concatenate(columns), np.concatenate(scores)

    def _look(self, near, bound, query, k, floor, column, score):
        """New floor of a target, and masters found with their scores, after a look at those whose bound is high enough."""
        high = np.flatnonzero(bound >= floor - _SINGLE)
        order = high[np.argsort(-bound[high], kind="stable")]
        near, bound, step = near[order], bound[order], k + 2
        while len(near) and bound[0] >= floor - _SINGLE:
            column = np.concatenate([column, near[:step]])
            score = np.concatenate([score, self._score(near[:step], query)])
            if len(score) >= k:
                floor = max(floor, np.partition(score, len(score) - k)[len(score) - k])
            keep = score >= floor
            column, score, near, bound, step = column[keep], score[keep], near[step:], bound[step:], min(2 * step, 1_024)
        return floor, (column, score)

    def _score(self, texts: np.ndarray, query) -> np.ndarray:
        own, weights, spread = query
        scores = []
        for a, b in zip(self.starts[texts].tolist(), self.starts[texts + 1].tolist()):
            tokens = self.tokens[a:b]
            if _SEARCHED * len(own) < b - a:
                at = np.searchsorted(tokens, own)
                at[at == b - a] = 0
                scores.append(np.where(tokens[at] == own, self.weights[a:b][at], 0.0) @ weights)
            else:
                scores.append(spread.take(tokens) @ self.weights[a:b])
        return np.round(scores, DECIMALS)


def _products(sketches: np.ndarray, chosen: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Products of some sketches and one, by the places of that one if these are few."""
    places = np.flatnonzero(query)
    if 4 * len(places) < len(query):
        return sketches[chosen[:, None], places] @ query[places]
    return sketches[chosen] @ query


def _spread_to(groups: np.ndarray, group_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in `groups`, place in `group_of`) of equal values."""
    order = np.argsort(group_of, kind="stable")
    first, last = (np.searchsorted(group_of[order], groups, side) for side in ("left", "right"))
    return np.repeat(np.arange(len(groups)), last - first), order[_slices(first, last - first)]


def _pieces(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut positions so that every piece but a single long entry stays below `limit`."""
    ends = np.cumsum(lengths)
    start, done = 0, 0
    while start < len(lengths):
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield start, stop
        start, done = stop, int(ends[stop - 1])


def _best(scores: np.ndarray, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, column, rounded score and rank of the k best cells of each row that reach its floor."""
    hits = scores >= (floors - _ROUNDED)[:, None]
    if np.count_nonzero(hits) > 2 * k * len(scores):
        at = scores.shape[1] - min(k, scores.shape[1])
        kth = scores.max(axis=1) if k == 1 else np.partition(scores, at, axis=1)[:, at]
        hits &= scores >= (kth - _ROUNDED)[:, None]
    row, column = np.nonzero(hits)
    score = np.round(scores[row, column], DECIMALS)
    reached = score >= floors[row]
    return _cut(row[reached], column[reached], score[reached], k)


def _search_tiles(tiles, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and score of the cells of all tiles that may belong to the k best of their row.

    What a row has found in a tile raises its floor, so that later tiles are compared with that only.
    """
    floors, none = np.array(floors, np.float64), np.zeros(0, np.int64)
    rows, columns, scores = [none], [none], [np.zeros(0)]
    for top, column_ids, found in tiles:
        if not found.size:
            continue
        at = top if isinstance(top, np.ndarray) else np.arange(top, top + len(found))
        row, column, score, rank = _best(found, k, floors[at])
        last = rank == k
        floors[at[row[last]]] = score[last]
        rows.append(at[row])
        columns.append(column_ids[column])
        scores.append(score)
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(scores)


def _cut(row, column, score, k):
    """The k best per row; of equal scores the smaller column goes first."""
    order = np.lexsort((column, -score, row))
    row, column, score = row[order], column[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
    keep = rank <= k
    return row[keep], column[keep], score[keep], rank[keep]


def prepare(masters: pa.Table, scorer):
    """Masters ordered by key, so that the first of equal scores is the smallest key."""
    masters = masters.sort_by(MASTER_KEY)
    return masters[MASTER_KEY].combine_chunks(), scorer.index(masters)


# The one broadcast index a Python worker keeps, so that its next task need not build it again.
_kept: dict = {}


def prepare_once(token: str, broadcast, scorer):
    if token not in _kept:
        _kept.clear()
        _kept[token] = prepare(broadcast.value, scorer)
    return _kept[token]


def match_block(targets: pa.Table, prepared, k: int, threshold: float) -> pa.Table:
    """(target_key, master_key, score, rank) of the k best masters of each target in the block."""
    step = max(1, int(len(targets) * min(1.0, _SLICE_BYTES / max(1, targets.nbytes))))
    if step < len(targets):
        parts = [targets.slice(i, step) for i in range(0, len(targets), step)]
        return pa.concat_tables([_match_slice(part, prepared, k, threshold) for part in parts])
    return _match_slice(targets, prepared, k, threshold)


def _match_slice(targets: pa.Table, prepared, k: int, threshold: float) -> pa.Table:
    keys, index = prepared
    floors = np.full(len(targets), float(threshold))
    if FLOOR in targets.column_names:
        floors = np.maximum(floors, targets[FLOOR].to_numpy())
    return _match_table(targets[TARGET_KEY], keys, _cut(*index.search(targets, k, floors), k))


def match_packed(targets: pa.Buffer, blocks: Iterable[pa.Buffer], k: int, threshold: float) -> Iterator[pa.Table]:
    """`match_block` of a block of targets with one block of masters after the other, all packed by `pack_texts`.

    What the targets have found in a block raises their floors, so that later blocks are looked through for more than that.
    """
    keys, counted = unpack_texts(targets)
    floors, rows, scores = np.full(len(keys), float(threshold)), np.zeros(0, np.int64), np.zeros(0)
    for masters in blocks:
        known_keys, known = unpack_texts(masters)
        found = _cut(*_LexicalIndex(known).search_counted(counted, k, floors), k)
        yield _match_table(keys, known_keys, found)
        rows, scores = np.concatenate([rows, found[0]]), np.concatenate([scores, found[2]])
        rows, _, scores, rank = _cut(rows, np.zeros_like(rows), scores, k)
        floors[rows[rank == k]] = scores[rank == k]


def _match_table(targets, masters, found) -> pa.Table:
    row, column, score, rank = found
    return pa.table(
        {
            TARGET_KEY: targets.take(pa.array(row, pa.int64())),
            MASTER_KEY: masters.take(pa.array(column, pa.int64())),
            SCORE: pa.array(score, pa.float64()),
            RANK: pa.array(rank, pa.int32()),
        }
    )
