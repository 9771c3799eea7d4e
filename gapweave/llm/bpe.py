"""Byte-level BPE encoding and decoding.

An Arrow pass cuts the words out. The distinct words that most stretches of documents hold are
encoded once and broadcast (a bounded number). Then another pass numbers the words of a stretch at once, so that
every other distinct word is encoded once per stretch; what it finds, one row per stretch, is handed over by a shuffle. To
encode, a higher-order function folds the ranked merges over the byte array of a word, with the ranks in a broadcast row.
Decoding concatenates the pieces of the ids. Words are told apart by their texts.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.llm.text import mix, word_hashes
from gapweave.storage import materialize

#: Distinct words of a task that are counted as one; this bounds its memory.
BATCH_DISTINCT = 50_000
#: Characters of a stretch, which is cut and numbered at once; a longer text is one alone. This bounds the memory of a task.
CUT_CHARACTERS = 1_500_000
#: The pattern that cuts texts, as for the public rank files; `cut_words` follows it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CLASS_PATTERNS = [regex.compile(p, regex.DOTALL) for p in (r"\p{L}", r"\p{N}", r"\s", ".")]
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4
#: Words that are encoded once for all batches, at most, and bytes of such a word.
COMMON_WORDS, COMMON_BYTES = 500_000, 64
#: Rows that leave the last pass at once hold about so many bytes.
OUTPUT_BYTES = 8 << 20
#: Longer words are merged by a heap in the numbering pass.
FOLD_BYTES = 1_000
#: The bits that ids and places are packed with.
_BITS = 21
_FIELD = 1 << _BITS
#: The rank of a pair that has none.
_NONE = _FIELD - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file (`base64 rank` per line, by a path the driver can read)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def _let(value: Column, body, empty: Column) -> Column:
    """`body` of a value that is computed once; `empty` is any value of the type of the result.

    An aggregate over one element. Taking the only element of a transformed array would do the same, but there Spark finds the
    type of the whole body anew for every value.
    """
    return F.aggregate(F.array(value), empty, lambda _, element: body(element))


def _spread(pairs: dict[int, int]) -> tuple[list[int], list[int]]:
    """(shifts, slots): the entry of a pair is in slot (pair + its bucket's shift) modulo the number of slots.

    A bucket is the pair modulo the number of shifts. So a look-up is two places of arrays, whatever the pair. An entry is the
    pair and its number; -1 where there is none.
    """
    count = len(pairs) // 4 + 1
    buckets: list[list[int]] = [[] for _ in range(count)]
    for pair in pairs:
        buckets[pair % count].append(pair)
    order = sorted((b for b in range(count) if buckets[b]), key=lambda b: -len(buckets[b]))
    size = len(pairs) + len(pairs) // 2 + 1
    while any(len({pair % size for pair in buckets[b]}) < len(buckets[b]) for b in order):
        size += 1  # two pairs of a bucket would share a slot whatever the shift
    shifts, slots = [0] * count, [-1] * size
    for b in order:
        own = [pair % size for pair in buckets[b]]
        shift = next((s for s in range(size) if all(slots[(at + s) % size] < 0 for at in own)), None)
        if shift is None:
            raise ValueError(f"no place for {len(own)} pairs of a bucket")
        shifts[b] = shift
        for pair in buckets[b]:
            slots[(pair + shift) % size] = pair << _BITS | pairs[pair]
    return shifts, slots


class RankMap:
    """The ranks as a table of one row, whose size is that of the rank file; it is broadcast.

    A literal would do the same, but Spark writes it out in every description of a plan and sends it with every task. A merge is
    looked up by its two parts: every cut of a piece into two pieces is an entry. A look-up in an array is a linear search, so an
    entry is where `_spread` puts it; nothing is built from the table per row. Two bytes have an array of their own.
    """

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        if max(ranks.values()) >= _NONE:
            raise ValueError(f"ranks must be below {_NONE}")
        self.pieces: dict[bytes, int] = ranks
        pairs: dict[int, int] = {}
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * _FIELD + right] = rank
        shifts, slots = _spread(pairs)
        one_byte = [ranks[bytes([b])] for b in range(256)]
        two_bytes = [ranks.get(bytes([a, b]), _NONE) for a in range(256) for b in range(256)]
        columns = {"rank_shifts": shifts, "rank_slots": slots, "rank_bytes": one_byte, "rank_two": two_bytes}
        self._counts = len(shifts), len(slots)
        self._table = pa.table({name: pa.array([values], pa.list_(pa.int64())) for name, values in columns.items()})

    def encoded(self, rows: DataFrame, *columns: str) -> DataFrame:
        """`columns` of `rows`, and as `tokens` the ids of each of the list of words in the column `words`."""
        joined = rows.crossJoin(F.broadcast(rows.sparkSession.createDataFrame(self._table)))
        tables = _Tables(*self._counts)
        return joined.select(*columns, F.transform("words", lambda word: _encode_word(word, tables)).alias("tokens"))


class _Tables:
    def __init__(self, shifts: int, slots: int):
        self._shifts, self._slots, self._bytes, self._two = (F.col(f"rank_{name}") for name in ("shifts", "slots", "bytes", "two"))
        self._counts = shifts, slots

    def of_byte(self, byte: Column) -> Column:
        return F.get(self._bytes, byte)

    def of_bytes(self, left: Column, right: Column) -> Column:
        """The rank of two bytes put together, like `of_pair` of their ids."""
        return F.coalesce(F.get(self._two, left.cast("int") * 256 + right.cast("int")), F.lit(_NONE).cast("bigint"))

    def of_pair(self, left: Column, right: Column) -> Column:
        """The rank of two parts put together; `_NONE` if there is none, or no part on the right."""
        none = F.lit(_NONE).cast("bigint")
        shifts, slots = self._counts

        def look_up(pair: Column) -> Column:
            shift = F.get(self._shifts, (pair % shifts).cast("int"))
            found = F.get(self._slots, ((pair + shift) % slots).cast("int"))
            return _let(
                found,
                lambda entry: F.when(F.shiftright(entry, _BITS) == pair, entry.bitwiseAND(F.lit(_FIELD - 1))).otherwise(none),
                none,
            )

        return _let(left * _FIELD + right, look_up, none)


def _encode_word(byte_array: Column, tables: _Tables) -> Column:
    """The ids of a word: of its bytes, the leftmost pair of least rank is merged until none is left.

    The fold keeps one number per part: the rank of the part with the next one, the place of its first byte and its id. So
    the least number is the leftmost pair of least rank. A merge replaces two parts by one, whose id is the rank, and
    looks up the ranks of the two pairs that it is in.
    """
    no_parts = F.array().cast("array<bigint>")
    id_of = lambda part: part.bitwiseAND(F.lit(_FIELD - 1))
    start_of = lambda part: part.bitwiseAND(F.lit((_FIELD - 1) << _BITS))

    def of_byte(byte: Column, i: Column) -> Column:
        rank = tables.of_bytes(byte, F.get(byte_array, i + 1))
        return _packed_part(rank, F.shiftleft(i.cast("bigint"), _BITS).bitwiseOR(tables.of_byte(byte)))

    def merge(parts: Column, least: Column) -> Column:
        rank = F.shiftright(least, 2 * _BITS)
        start = start_of(least)

        def at(place: Column) -> Column:  # of the left part, from 1
            before, after = F.get(parts, place - 2), F.get(parts, place + 1)
            own = _packed_part(tables.of_pair(rank, id_of(after)), start.bitwiseOR(rank))
            other = _packed_part(tables.of_pair(id_of(before), rank), before.bitwiseAND(F.lit((1 << 2 * _BITS) - 1)))
            return F.flatten(
                F.array(
                    F.slice(parts, F.lit(1), F.greatest(place - 2, F.lit(0))),
                    F.when(place > 1, F.array(other, own)).otherwise(F.array(own)),
                    F.slice(parts, place + 2, F.size(parts)),
                )
            )

        # Parts are in order; array_position would leave its loop by an exception, which takes longer than the rest of a merge.
        return _let(F.size(F.filter(parts, lambda part: start_of(part) <= start)), at, no_parts)

    return F.aggregate(
        F.sequence(F.lit(2), F.size(byte_array)),  # no more merges than that
        F.transform(byte_array, of_byte),
        lambda parts, _: _let(
            F.array_min(parts),
            lambda least: F.when(least < F.lit(_NONE << 2 * _BITS), merge(parts, least)).otherwise(parts),
            no_parts,
        ),
        lambda parts: F.transform(parts, lambda part: id_of(part).cast("int")),
    )


def _packed_part(rank: Column, start_and_id: Column) -> Column:
    return F.shiftleft(rank, 2 * _BITS).bitwiseOR(start_and_id)


def encode_long_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges by a heap, for words whose length would make the fold slow (n log n instead of n * n)."""
    ends = list(range(1, len(word) + 1))  # of the part that starts here; 0: no part starts here
    starts = list(range(-1, len(word)))  # of the part that ends here
    ends.append(0)

    def candidate(start: int) -> tuple[int, int, int] | None:
        middle = ends[start]
        if middle >= len(word):
            return None
        rank = ranks.get(word[start : ends[middle]])
        return None if rank is None else (rank, start, ends[middle])

    heap = [c for i in range(len(word)) if (c := candidate(i))]
    heapq.heapify(heap)
    while heap:
        _, start, end = heapq.heappop(heap)
        middle = ends[start]
        if not middle or middle >= len(word) or ends[middle] != end or middle == end:
            continue  # one of the two parts has changed since
        ends[start], ends[middle], starts[end] = end, 0, start
        for each in (starts[start], start):
            if each >= 0 and (c := candidate(each)):
                heapq.heappush(heap, c)
    ids, at = [], 0
    while at < len(word):
        ids.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return ids


def _classes(codes: np.ndarray, known: dict) -> np.ndarray:
    """L, N, S (white space) or O for every code point; `known` keeps what has been looked up."""
    if "table" not in known:
        known["table"] = np.zeros(0x110000, np.uint8)
    table = known["table"]
    new = np.unique(codes[table[codes] == 0])
    for code in new:
        char = chr(code)
        table[code] = next(n for n, (pattern) in enumerate(_CLASS_PATTERNS, 1) if pattern.fullmatch(char))
    return table[codes]


def cut_words(texts: list[str], known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all texts, start, end, text number) of the words that `PATTERN` cuts texts into, in order.

    Runs of letters, of numbers, of other marks and of white space are found for all texts at once. A run takes the
    blank before it along; of other white space before a run the last character stands alone; an apostrophe alone
    takes the ending of a contraction along.
    """
    sizes = np.array([len(text) for text in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    rows = np.concatenate([[0], np.cumsum(sizes)])
    if not len(codes):
        none = np.zeros(0, np.int64)
        return codes, none, none, none
    kind = _classes(codes, known)
    edge = np.concatenate([[True], kind[1:] != kind[:-1]])
    edge[rows[:-1][sizes > 0]] = True
    start = np.flatnonzero(edge)
    end = np.append(start[1:], len(codes))
    of_run = kind[start]
    text = np.searchsorted(rows, start, "right") - 1
    last = np.append(text[1:] != text[:-1], True)  # the last run of its text
    space = of_run == _SPACE
    # White space before another run: all but its last character, then that character, unless it is a blank taken along.
    broken = space & ~last
    taken = broken & (codes[end - 1] == 32)
    start_of = start.copy()
    start_of[1:][taken[:-1]] -= 1
    head = start[broken & (end - start > 1)]
    alone = end[broken & ~taken] - 1
    # Contractions: an apostrophe that is a run of its own and a word of its own, and what follows it.
    single = np.flatnonzero((of_run == _OTHER) & (end - start == 1) & (start_of == start) & (codes[start] == 39) & ~last)
    single = single[of_run[single + 1] == _LETTER]
    first = codes[start[single + 1]]
    long = end[single + 1] - start[single + 1] > 1
    second = np.where(long, codes[np.minimum(start[single + 1] + 1, len(codes) - 1)], 0)
    one = np.isin(first, [ord(c) for c in "stmd"])
    two = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
    more = np.where(one, 1, np.where(two, 2, 0))
    taking = single[more > 0]
    rest = start[taking + 1] + more[more > 0]
    keep = ~(broken | np.isin(np.arange(len(start)), taking + 1))
    begins = np.sort(np.concatenate([start_of[keep], head, alone, rest[rest < end[taking + 1]]]))
    ends = np.append(begins[1:], len(codes))
    return codes, begins, ends, np.searchsorted(rows, begins, "right") - 1


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the distinct values, where each is first, place of every value among them), in order of appearance."""
    place, distinct = pd.factorize(hashes)
    first = np.empty(len(distinct), np.int64)
    first[place[::-1]] = np.arange(len(place) - 1, -1, -1)
    return distinct, first, place


def _byte_hashes(text: str, codes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hashes of the words by their UTF-8 bytes, which takes fewer steps than by code points."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    at = np.arange(len(codes) + 1)
    if len(data) > len(codes):
        sizes = np.ones(len(codes), np.int64)
        for least in (0x80, 0x800, 0x10000):
            sizes += codes >= least
        at[1:] = np.cumsum(sizes)
    return word_hashes(data, at[start], at[np.append(start[1:], len(codes))])


def _equal_words(codes: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray) -> bool:
    """Whether every word is the same as another one given by its number; words follow each other without a gap."""
    sizes, shift = end - start, start[other] - start
    if (sizes != sizes[other]).any():
        return False
    return bool((codes == codes[np.arange(len(codes)) + np.repeat(shift, sizes)]).all())


def _numbered(column: pa.Array, known: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """(first row, words per row, place of every word among the distinct ones, their hashes, their texts) by stretches."""
    at = 0
    while at < len(column):
        texts, size = [], 0
        while at + len(texts) < len(column) and (not texts or size < CUT_CHARACTERS):
            texts.append(column[at + len(texts)].as_py() or "")
            size += len(texts[-1])
        codes, start, end, row = cut_words(texts, known)
        joined = "".join(texts)
        hashes = _byte_hashes(joined, codes, start)
        distinct, first, place = _distinct(hashes)
        # If equal hashes are not equal words, which is not to be expected, the texts tell them apart.
        if not _equal_words(codes, start, end, first[place]):
            known_texts: dict[str, int] = {}
            whole = [joined[a:b] for a, b in zip(start.tolist(), end.tolist())]
            hashes = mix(np.array([known_texts.setdefault(w, len(known_texts)) for w in whole], np.uint64))
            distinct, first, place = _distinct(hashes)
        words = [joined[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]
        yield at, np.bincount(row, minlength=len(texts)), place, distinct, words
        at += len(texts)


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of many documents at a time, without those too long to be common."""
    seen: dict[int, str] = {}
    known: dict = {}

    def flush() -> pa.RecordBatch:
        column = pa.array(seen.values(), pa.string())
        hashes = np.fromiter(seen.keys(), np.uint64, len(seen)).view(np.int64)
        short = pc.less_equal(pc.binary_length(column), COMMON_BYTES)
        return pa.RecordBatch.from_arrays([pa.array(hashes).filter(short), column.filter(short)], ["hash", "word"])

    for batch in batches:
        for _, _, _, distinct, words in _numbered(batch.column(0), known):
            seen.update(zip(distinct.tolist(), words))
            if len(seen) >= BATCH_DISTINCT:
                yield flush()
                seen = {}
    if seen:
        yield flush()


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words as lists that `RankMap.encoded` takes."""
    for batch in batches:
        words = _byte_lists(batch.column(1).cast(pa.binary()).to_pylist())
        yield pa.RecordBatch.from_arrays([_one_list(batch.column(0)), _one_list(words)], ["hashes", "words"])


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(np.array([0, len(values)], np.int32), values)


def _byte_lists(words: list[bytes]) -> pa.ListArray:
    starts = np.concatenate([[0], np.cumsum([len(word) for word in words], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(starts, pa.array(np.frombuffer(b"".join(words), np.uint8).astype(np.int16)))


def _packed(values: np.ndarray) -> bytes:
    """Numbers in as few bytes as they need; shuffles compress them."""
    most = int(values.max(initial=0))
    kind = np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def common_words(texts: DataFrame, ranks: RankMap, limit: int | None = None) -> tuple[np.ndarray, pa.Array]:
    """The hashes of the words that the most batches of documents hold, in order, and their ids.

    They are encoded once; all other words are encoded where they occur. The result is broadcast: at most `limit`
    (`COMMON_WORDS`) words of at most `COMMON_BYTES` bytes.
    """
    words = texts.select("text").mapInArrow(_distinct_words, "hash bigint, word string")
    spread = words.groupBy("hash", "word").agg(F.count("*").alias("n"))
    spread = materialize(spread.where("n > 1").withColumn("level", F.floor(F.log2("n") * 8).cast("int")), "words")
    levels = {row["level"]: row["count"] for row in spread.groupBy("level").count().collect()}  # a few hundred rows
    least, total = None, 0
    for level in sorted(levels, reverse=True):
        total += levels[level]
        if total > (COMMON_WORDS if limit is None else limit):
            break
        least = level
    if least is None:
        return np.zeros(0, np.uint64), pa.array([], pa.list_(pa.int32()))
    lists = spread.where(F.col("level") >= least).select("hash", "word").mapInArrow(
        _word_lists, "hashes array<bigint>, words array<array<smallint>>"
    )
    table = ranks.encoded(lists, "hashes").toArrow()
    hashes = table.column("hashes").combine_chunks().flatten().to_numpy().view(np.uint64)
    ids = table.column("tokens").combine_chunks().flatten().cast(pa.list_(pa.int32()))
    order = np.argsort(hashes)
    return hashes[order], ids.take(pa.array(order))


def _number_words(vocabulary: dict[bytes, int], common):
    """Batches of documents -> one row per stretch: its distinct words, and their numbers in each document.

    A row holds its documents' ids, and packed the words of each, the words by number, the sizes of the words' ids where
    these are known and these ids; and the words that are left to fold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_ids = common.value
        classes: dict = {}
        for batch in batches:
            for first, per_row, place, hashes, words in _numbered(batch.column(1), classes):
                at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
                hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
                # Ids of the common words; then of words that are a piece themselves, never cut, and of long ones, by the heap.
                own, own_ids, open_words = [], [], []
                for i in np.flatnonzero(~hit).tolist():
                    word = words[i].encode()
                    if word in vocabulary:
                        own.append(i)
                        own_ids.append([vocabulary[word]])
                    elif len(word) > FOLD_BYTES:
                        own.append(i)
                        own_ids.append(encode_long_word(word, vocabulary))
                    else:
                        open_words.append(word)
                numbers = np.concatenate([np.flatnonzero(hit), np.array(own, np.int64)])
                order = np.argsort(numbers)
                given = pa.concat_arrays([known_ids.take(pa.array(at[hit])), pa.array(own_ids, pa.list_(pa.int32()))])
                given = given.take(pa.array(order))
                sizes = np.zeros(len(words), np.int64)  # 0: to be folded
                sizes[numbers[order]] = pc.list_value_length(given).to_numpy(zero_copy_only=False)
                packed = (per_row, place, sizes, given.flatten().to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [
                        _one_list(batch.column(0).slice(first, len(per_row))),
                        *(pa.array([_packed(values)], pa.binary()) for values in packed),
                        _one_list(_byte_lists(open_words)),
                        pa.array([int(hashes.sum(dtype=np.uint64)) >> 1], pa.int64()),
                    ],
                    ["ids", "counts", "codes", "sizes", "given", "words", "spread"],
                )

    return run


def _merge_lists(known: np.ndarray, given: np.ndarray, folded: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Ids of all words of a batch, and how many each has, from the known ones and the folded ones."""
    is_known = known > 0
    starts = np.concatenate([[0], np.cumsum(known[is_known])]).astype(np.int32)
    both = pa.concat_arrays([pa.ListArray.from_arrays(starts, pa.array(given.astype(np.int32))), folded.cast(pa.list_(pa.int32()))])
    order = np.empty(len(known), np.int64)
    order[is_known] = np.arange(is_known.sum())
    order[~is_known] = is_known.sum() + np.arange((~is_known).sum())
    merged = both.take(pa.array(order))
    return merged, pc.list_value_length(merged).to_numpy(zero_copy_only=False)


def _per_document(
    batches: Iterator[pa.RecordBatch], pieces: pa.Array, decimals: pa.Array | None = None
) -> Iterator[pa.RecordBatch]:
    """Ids of every document from the rows of batches, decoded by joining their `pieces`; as text with `decimals`."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch.column("ids").slice(row, 1).flatten()
            counts, codes, known, given = (
                _unpacked(batch.column(name)[row].as_py()) for name in ("counts", "codes", "sizes", "given")
            )
            tokens, sizes = _merge_lists(known, given, batch.column("tokens").slice(row, 1).flatten())
            ends = np.concatenate([[0], np.cumsum(counts)])
            cost = np.concatenate([[0], np.cumsum(sizes[codes], dtype=np.int64)])[ends] * 4
            first = 0
            while first < len(ids):
                last = max(first + 1, int(np.searchsorted(cost, cost[first] + OUTPUT_BYTES, "right")) - 1)
                own = codes[ends[first] : ends[last]]
                picked = pa.array(own)
                starts = np.concatenate([[0], np.cumsum(sizes[own], dtype=np.int64)])[ends[first : last + 1] - ends[first]]
                starts = pa.array(starts.astype(np.int32))
                found = tokens.take(picked).flatten()
                joined = lambda texts, mark: pc.binary_join(pa.ListArray.from_arrays(starts, texts.take(found)), mark)  # noqa: B023, E731
                columns = {
                    "id": ids.slice(first, last - first),
                    "token_ids": pa.ListArray.from_arrays(starts, found),
                    "decoded": joined(pieces, b""),
                }
                if decimals is not None:
                    columns["ids_text"] = joined(decimals, " ")
                yield pa.RecordBatch.from_pydict(columns)
                first = last


def encode(
    docs: DataFrame, ranks: RankMap, id_column: str = "doc_id", text_column: str = "text", ids_text: bool = False
) -> DataFrame:
    """Encodes every whole text and decodes the ids again.

    Returns one row per row of `docs`: the id column (repeated or null ids included), `token_ids`
    (array<int>, without special tokens) and `decoded` (the bytes of the ids). A null text counts as empty and
    has no ids. With `ids_text` there is also a column of that name, the decimal ids joined by blanks. Other columns are
    ignored. A word of n bytes costs n * n steps up to `FOLD_BYTES`, beyond that n * log(n).
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    common = docs.sparkSession.sparkContext.broadcast(common_words(texts, ranks))
    # Between the two Python passes stands a shuffle, so that a task never runs workers of both.
    numbered = texts.mapInArrow(
        _number_words(ranks.pieces, common),
        f"ids array<{id_type}>, counts binary, codes binary, sizes binary, given binary, words array<array<smallint>>, "
        "spread bigint",
    ).repartition("spread")
    encoded = ranks.encoded(numbered, "ids", "counts", "codes", "sizes", "given")
    by_rank = {rank: piece for piece, rank in ranks.pieces.items()}
    pieces = pa.array([by_rank.get(rank) for rank in range(max(by_rank) + 1)], pa.binary())
    decimals = pa.array([str(rank) for rank in range(len(pieces))]) if ids_text else None

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _per_document(batches, pieces, decimals)

    columns = f"id {id_type}, token_ids array<int>, decoded binary" + (", ids_text string" if ids_text else "")
    return encoded.mapInArrow(assemble, columns).withColumnRenamed("id", id_column)
