"""Removal of byte strings that repeat from earlier documents, by external suffix sorting.

A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller id.

1. Every window of `length` bytes has a minimizer: the k-gram in it with the least hash. Windows in a row with
   the same minimizer form a stretch; equal windows lie in stretches with the same k-gram. Stretches go, as hashes,
   to parts of the k-gram's hash. Where all stretches of a k-gram are equal, nothing needs to be sorted: all but the
   one of the smallest id go. The same holds within a task, so a passage that is everywhere is sent once per task.
2. Where a k-gram has different stretches, one copy of each goes, as bytes, to a shard by the k-gram. There its
   suffixes are sorted outside memory: tuples (prefix, owner, place) are sorted in runs on the task's disk, which a
   priority queue merges block by block. Common-prefix values of neighbours tell which windows are equal.
3. The removed ranges of a document are joined to its text.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.text import CHUNK_BYTES, prefix_hashes, range_hashes, text_chunks
from gapweave.storage import materialize

LENGTH, GRAM = 50, 20
#: Stretches that one task compares, and bytes of stretches that one task sorts.
PART_STRETCHES, SHARD_BYTES = 3_000_000, 8 << 20
#: Suffixes of a sorted run, and suffixes of a run that the merge holds in memory at once.
RUN_ROWS, BLOCK_ROWS = 300_000, 30_000
#: Places in a text take 31 bits, as many as the longest value of a row needs; the rest is hash.
_PLACE = np.uint64((1 << 31) - 1)
_SHORT = np.uint64((1 << 48) - 1)


def stretches(data: np.ndarray, rows: np.ndarray, length: int, gram: int):
    """(start, number of windows, hash of the k-gram, hash of the bytes) of the stretches in texts, in order."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    sums, back = prefix_hashes(data)
    starts = np.arange(len(data) - gram + 1)
    grams = range_hashes(sums, back, starts, starts + gram)
    # The hash above, the place below: the least number is the leftmost k-gram with the least hash.
    keyed = (grams & ~_PLACE) | starts.astype(np.uint64)
    width = length - gram + 1
    count = len(keyed) - width + 1
    padded = np.concatenate([keyed, np.full(-len(keyed) % width, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = (np.minimum(backward[:count], forward[width - 1 : width - 1 + count]) & _PLACE).astype(np.int64)
    # Windows that leave their row do not count.
    sizes = np.diff(rows)
    whole = np.zeros(len(data) + 1, np.int64)
    np.add.at(whole, rows[:-1][sizes >= length], 1)
    np.add.at(whole, (rows[1:] - length + 1)[sizes >= length], -1)
    valid = np.cumsum(whole)[:count] > 0
    begins = valid & np.concatenate([[True], (least[1:] != least[:-1]) | ~valid[:-1]])
    first = np.flatnonzero(begins)
    ends = valid & np.concatenate([(least[1:] != least[:-1]) | ~valid[1:], [True]])
    last = np.flatnonzero(ends)
    return first, last - first + 1, grams[least[first]], range_hashes(sums, back, first, last + length)


def _text_refs(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A hash of each text, which tells apart rows that share an id.

    Texts may be of any length, so no polynomial is taken: modulo 2**64 it takes certain patterns of 1,024 bytes and more
    for one. Stretches are shorter than `2 * length` bytes, where these patterns do not meet.
    """
    bounds, view = rows.tolist(), memoryview(np.ascontiguousarray(data))
    digests = b"".join(hashlib.blake2b(view[a:b], digest_size=8).digest() for a, b in zip(bounds, bounds[1:]))
    return np.frombuffer(digests, np.int64)


def _owner_rows(ids, refs, owner: np.ndarray, values: np.ndarray):
    """Values grouped by owner, as (id, ref, packed values)."""
    order = np.argsort(owner, kind="stable")
    owner, values = owner[order], values[order]
    bounds = np.concatenate([np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])), [len(owner)]]) if len(owner) else np.zeros(1, np.int64)
    heads = owner[bounds[:-1]]
    return ids[heads], refs[heads], [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def _compare(docs: DataFrame, length: int, gram: int, parts: int) -> DataFrame:
    """(id, ref, gone, sent): hashes of the stretches of a document that go, and of those that must be sorted."""
    fields = ["part", "ids", "refs", "grams", "hashes", "owners", "done", "done_owners"]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, rows in text_chunks(batch.column(1)):
                ids, refs = all_ids[first:last], _text_refs(data, rows)
                start, _, of_gram, of_bytes = stretches(data, rows, length, gram)
                if not len(start):
                    continue
                owner = np.searchsorted(rows, start, "right") - 1
                of_bytes &= _SHORT
                order = np.lexsort((ids[owner], of_bytes, of_gram))
                of_gram, of_bytes, owner = of_gram[order], of_bytes[order], owner[order]
                head = np.concatenate([[True], (of_gram[1:] != of_gram[:-1]) | (of_bytes[1:] != of_bytes[:-1])])
                group = np.cumsum(head) - 1
                # The same stretch in a smaller document of this task settles it here.
                done = ids[owner] > ids[owner[head]][group]
                repeat = ~head & ~done & (owner == owner[np.maximum(np.arange(len(owner)) - 1, 0)])
                live = ~done & ~repeat
                part = ((of_gram >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
                done_part = (refs[owner].view(np.uint64) % np.uint64(parts)).astype(np.int64)
                out = []
                for p in np.unique(np.concatenate([part[live], done_part[done]])):
                    a, b = live & (part == p), done & (done_part == p)
                    a, b = np.flatnonzero(a), np.flatnonzero(b)
                    a = a[np.argsort(owner[a], kind="stable")]
                    used, local = np.unique(np.concatenate([owner[a], owner[b]]), return_inverse=True)
                    out.append(
                        (
                            int(p),
                            ids[used].astype(np.int64).tobytes(),
                            refs[used].tobytes(),
                            (of_gram[a] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                            of_bytes[a].view(np.uint8).reshape(-1, 8)[:, :6].tobytes(),
                            local[: len(a)].astype(np.uint32).tobytes(),
                            of_bytes[b].tobytes(),
                            local[len(a) :].astype(np.uint32).tobytes(),
                        )
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(zip(*out))], fields
                )

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        join = lambda name, kind: np.frombuffer(b"".join(frame[name]), kind)
        ids, refs = join("ids", np.int64), join("refs", np.int64)
        shift = np.concatenate([[0], np.cumsum([len(x) // 8 for x in frame["ids"]])])[:-1]
        owner = join("owners", np.uint32).astype(np.int64) + np.repeat(shift, [len(x) // 4 for x in frame["owners"]])
        done_owner = join("done_owners", np.uint32).astype(np.int64) + np.repeat(
            shift, [len(x) // 4 for x in frame["done_owners"]]
        )
        of_gram = join("grams", np.uint32)
        wide = np.zeros((len(of_gram), 8), np.uint8)
        wide[:, :6] = join("hashes", np.uint8).reshape(-1, 6)
        of_bytes = wide.view(np.uint64).ravel()
        order = np.lexsort((refs[owner], ids[owner], of_bytes, of_gram))
        of_gram, of_bytes, owner = of_gram[order], of_bytes[order], owner[order]
        if len(order):
            new_gram = np.concatenate([[True], of_gram[1:] != of_gram[:-1]])
            head = new_gram | np.concatenate([[True], of_bytes[1:] != of_bytes[:-1]])
            least = ids[owner[head]]
            gone = ids[owner] > least[np.cumsum(head) - 1]
            # A k-gram whose stretches differ and belong to several documents: one copy of each stretch is sorted, or
            # one for each text that shares the smallest id.
            text = refs[owner]
            copy = (ids[owner] == least[np.cumsum(head) - 1]) & (head | np.concatenate([[True], text[1:] != text[:-1]]))
            gram_of = np.cumsum(new_gram) - 1
            low = np.minimum.reduceat(least, np.flatnonzero(new_gram[head]))
            high = np.maximum.reduceat(least, np.flatnonzero(new_gram[head]))
            sent = copy & (low != high)[gram_of]
        else:
            gone = sent = np.zeros(0, bool)
        pieces = []
        six = lambda values: values.view(np.uint8).reshape(-1, 8)[:, :6]
        for name, at, values in (
            ("gone", np.concatenate([owner[gone], done_owner]), np.concatenate([of_bytes[gone], join("done", np.uint64)])),
            ("sent", owner[sent], of_bytes[sent]),
        ):
            i, r, v = _owner_rows(ids, refs, at, six(values))
            pieces.append(pd.DataFrame({"id": i, "ref": r, "gone": None, "sent": None} | {name: v}))
        return pd.concat(pieces, ignore_index=True)

    binary = ", ".join(f"{name} binary" for name in fields[1:])
    packed = docs.select("id", "text").mapInArrow(spread, f"part bigint, {binary}")
    return packed.groupBy("part").applyInPandas(settle, "id bigint, ref bigint, gone binary, sent binary")


def _own(column: pa.Array, row: int, ref: int, name: str, kind) -> np.ndarray:
    """The packed numbers that a list of structs (ref, ...) holds for one text."""
    parts = column[row].as_py() or []
    return np.frombuffer(b"".join(p[name] for p in parts if p["ref"] == ref and p[name]), kind)


def _own_hashes(column: pa.Array, row: int, ref: int, name: str) -> np.ndarray:
    six = _own(column, row, ref, name, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, :6] = six
    return wide.view(np.uint64).ravel()


def _squeezed(docs: DataFrame) -> DataFrame:
    """(id, text) with the texts compressed, as both joins move them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(pack, texts), pa.binary())], ["id", "text"])

    return docs.select("id", "text").mapInArrow(run, "id bigint, text binary")


def _texts(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of stretches of compressed texts, unpacked a bounded number of bytes at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    first, held, size = 0, [], 0
    for row, each in enumerate(column):
        held.append(unpack(each.as_py()))
        size += len(held[-1])
        if size >= 4 * CHUNK_BYTES or row == len(column) - 1:
            yield first, pa.array(held, pa.large_binary())
            first, held, size = row + 1, [], 0


def _chunks(column: pa.Array) -> Iterator[tuple[int, tuple]]:
    for base, texts in _texts(column):
        for chunk in text_chunks(texts):
            yield base, chunk


def _sent_stretches(docs: DataFrame, flags: DataFrame, length: int, gram: int, shards: int) -> DataFrame:
    """(shard, id, ref, start, bytes) of one copy of each stretch that must be sorted."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for base, (first, last, data, rows) in _chunks(batch.column(1)):
                first, last = base + first, base + last
                refs = _text_refs(data, rows)
                start, windows, of_gram, of_bytes = stretches(data, rows, length, gram)
                bounds = np.searchsorted(start, rows)
                out = []
                for row in range(last - first):
                    a, b = bounds[row], bounds[row + 1]
                    wanted = _own_hashes(batch.column(2), first + row, int(refs[row]), "sent")
                    for i in np.flatnonzero(np.isin(of_bytes[a:b] & _SHORT, wanted)) + a:
                        end = start[i] + windows[i] + length - 1
                        shard = int((of_gram[i] >> np.uint64(20)) % np.uint64(shards))
                        head = (shard, int(all_ids[first + row]), int(refs[row]), int(start[i] - rows[row]))
                        out.append((*head, data[start[i] : end].tobytes()))
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["shard", "id", "ref", "start", "bytes"]
                    )

    wanted = flags.where(F.col("sent").isNotNull()).groupBy("id").agg(F.collect_list(F.struct("ref", "sent")).alias("own"))
    rows = _squeezed(docs).join(wanted, "id").select("id", "text", "own")
    return rows.mapInArrow(cut, "shard bigint, id bigint, ref bigint, start bigint, bytes binary")


class SuffixRuns:
    """Sorted runs of suffixes on the task's disk, merged by a queue of their next blocks.

    The texts lie in one file and a run holds (place in it, owner), so a block of a run becomes suffix tuples (prefix,
    place, owner) when it is read. A prefix is `length` bytes as big-endian words of 64 bits, which compare like bytes.
    """

    def __init__(self, texts: list[bytes], length: int):
        self.length, self.words = length, -(-length // 8)
        self.runs: list[tuple] = []
        self.file = tempfile.TemporaryFile()  # noqa: SIM115  closed below, and gone with the task in any case
        self.file.writelines(texts)
        self.file.flush()
        self.windows = np.lib.stride_tricks.sliding_window_view(np.memmap(self.file, np.uint8, "r"), length)

    def add(self, place: np.ndarray, owner: np.ndarray) -> None:
        rows = self._tuples(np.stack([place, owner], axis=1).astype(np.uint64))
        out = tempfile.TemporaryFile()  # noqa: SIM115
        rows[self._order(rows)][:, self.words :].tofile(out)
        self.runs.append((out, len(rows)))

    def _tuples(self, pairs: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(pairs), self.words * 8), np.uint8)
        wide[:, : self.length] = self.windows[pairs[:, 0].astype(np.int64)]
        return np.concatenate([wide.view(">u8").astype(np.uint64), pairs], axis=1)

    def _order(self, rows: np.ndarray) -> np.ndarray:
        return np.lexsort(tuple(rows[:, w] for w in range(self.words - 1, -1, -1)))

    def _key(self, row: np.ndarray) -> tuple[int, ...]:
        return tuple(row[: self.words].tolist())

    def _blocks(self, file, left: int) -> Iterator[np.ndarray]:
        file.seek(0)
        while left:
            pairs = np.fromfile(file, np.uint64, min(left, BLOCK_ROWS) * 2).reshape(-1, 2)
            left -= len(pairs)
            yield self._tuples(pairs)

    def _upto(self, rows: np.ndarray, bound: tuple[int, ...]) -> int:
        low, high = 0, len(rows)
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self._key(rows[middle]) <= bound else (low, middle)
        return low

    def merged(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(common prefix with the tuple before, place, owner) of all tuples in order; equal prefixes come together.

        The common prefix is given in whole words, or as the length where all is equal.
        """
        readers = [self._blocks(*run) for run in self.runs]
        held = [next(reader, None) for reader in readers]
        queue = [(self._key(block[-1]), n) for n, block in enumerate(held) if block is not None]
        heapq.heapify(queue)
        while queue:
            bound = queue[0][0]
            # Runs whose block ends with the bound may go on with it.
            while queue and queue[0][0] == bound:
                _, n = heapq.heappop(queue)
                if (more := next(readers[n], None)) is not None:
                    held[n] = np.concatenate([held[n], more])
                    heapq.heappush(queue, (self._key(more[-1]), n))
            ready = []
            for n, block in enumerate(held):
                if block is not None and (cut := self._upto(block, bound)):
                    ready.append(block[:cut])
                    held[n] = block[cut:] if cut < len(block) else None
            batch = np.concatenate(ready)
            batch = batch[self._order(batch)]
            common = np.zeros(len(batch), np.int64)
            going = np.ones(len(batch) - 1, bool)
            for w in range(self.words):  # whole words first; the first word that differs ends it
                going &= batch[1:, w] == batch[:-1, w]
                common[1:][going] += 8
            yield np.minimum(common, self.length), batch[:, self.words].astype(np.int64), batch[:, self.words + 1].astype(np.int64)

    def close(self) -> None:
        for file in (self.file, *(run for run, _ in self.runs)):
            file.close()


def equal_windows(texts: list[bytes], ids: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, place) of the windows that also are in a text of a smaller id."""
    sizes = np.array([len(text) for text in texts])
    first = np.concatenate([[0], np.cumsum(sizes)])
    windows = sizes - length + 1
    upto = np.concatenate([[0], np.cumsum(windows)])
    runs = SuffixRuns(texts, length)
    try:
        at = 0
        while at < len(texts):
            last = max(at + 1, int(np.searchsorted(upto, upto[at] + RUN_ROWS, "right")) - 1)
            owner = np.repeat(np.arange(at, last), windows[at:last])
            runs.add(first[owner] + np.arange(upto[at], upto[last]) - upto[owner], owner)
            at = last
        for common, place, owner in runs.merged():
            head = np.flatnonzero(common < length)
            least = np.minimum.reduceat(ids[owner], head)
            gone = ids[owner] > np.repeat(least, np.diff(np.append(head, len(owner))))
            yield owner[gone], place[gone] - first[owner[gone]]
    finally:
        runs.close()


def _sort_shards(sent: DataFrame, length: int) -> DataFrame:
    """(id, ref, ranges): packed (start, end) of the byte ranges that the sorted windows remove."""

    def sort(frame: pd.DataFrame) -> pd.DataFrame:
        ids, start = frame["id"].to_numpy(), frame["start"].to_numpy()
        found = list(equal_windows(list(frame["bytes"]), ids, length))
        owner = np.concatenate([np.zeros(0, np.int64), *(o for o, _ in found)])
        begin = np.concatenate([np.zeros(0, np.int64), *(p for _, p in found)]) + start[owner]
        order = np.lexsort((begin, owner))
        owner, begin = owner[order], begin[order]
        if not len(owner):
            return pd.DataFrame({"id": [], "ref": [], "ranges": []})
        # Windows that follow one another are one range.
        head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (begin[1:] != begin[:-1] + 1)]))
        tail = np.append(head[1:], len(owner)) - 1
        pairs = np.stack([begin[head], begin[tail] + length], axis=1)
        i, r, v = _owner_rows(ids, frame["ref"].to_numpy(), owner[head], pairs)
        return pd.DataFrame({"id": i, "ref": r, "ranges": v})

    return sent.groupBy("shard").applyInPandas(sort, "id bigint, ref bigint, ranges binary")


def _cut_texts(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, (first, last, data, rows) in _chunks(batch.column(1)):
                first, last = base + first, base + last
                refs = _text_refs(data, rows)
                known = [batch.column(2)[first + row].is_valid for row in range(last - first)]
                start, windows, _, of_bytes = stretches(data, rows, length, gram) if any(known) else [np.zeros(0, np.int64)] * 4
                bounds = np.searchsorted(start, rows)
                removed, spans, kept = [], [], []
                for row in range(last - first):
                    text = data[rows[row] : rows[row + 1]]
                    if not known[row]:
                        removed.append(0), spans.append(0), kept.append(text.tobytes())
                        continue
                    ref, a, b = int(refs[row]), bounds[row], bounds[row + 1]
                    gone = np.isin(of_bytes[a:b].astype(np.uint64) & _SHORT, _own_hashes(batch.column(2), first + row, ref, "gone"))
                    ranges = _own(batch.column(2), first + row, ref, "ranges", np.int64).reshape(-1, 2)
                    begin = start[a:b][gone] - rows[row]
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, np.concatenate([begin, ranges[:, 0]]), 1)
                    np.add.at(edge, np.concatenate([begin + windows[a:b][gone] + length - 1, ranges[:, 1]]), -1)
                    out = np.cumsum(edge)[:-1] > 0
                    removed.append(int(out.sum()))
                    spans.append(int((out & ~np.concatenate([[False], out[:-1]])).sum()))
                    kept.append(text[~out].tobytes())
                sizes = np.diff(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(sizes),
                        pa.array(removed, pa.int64()),
                        pa.array(spans, pa.int64()),
                        pa.array(kept, pa.binary()),
                    ],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return run


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary) of every row of `docs`.

    Texts are their UTF-8 bytes, a null text none; strings are judged on the input and never cross documents. Ids are
    integers. Rows that share an id do not remove each other's strings; rows with a null id keep everything and remove
    nothing. Strings are compared by 48 and more bits of hash within a k-gram, or byte by byte in the sort. Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    named = rows.where(F.col("id").isNotNull() & (F.octet_length("text") >= length))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About two minimizers for each stretch of windows.
    parts = max(8, -(-2 * size // (length - gram + 2) // PART_STRETCHES))
    flags = materialize(_compare(named, length, gram, parts), "flags")
    sent_bytes = flags.agg(F.sum(F.octet_length("sent"))).first()[0] or 0
    shards = max(8, -(-sent_bytes // 6 * (2 * length - gram) // SHARD_BYTES))
    ranges = _sort_shards(_sent_stretches(named, flags, length, gram, shards), length)
    none = F.lit(None).cast("binary")
    out = flags.where(F.col("gone").isNotNull()).select("id", "ref", "gone", none.alias("ranges")).unionByName(
        ranges.select("id", "ref", none.alias("gone"), "ranges")
    )
    own = out.groupBy("id").agg(F.collect_list(F.struct("ref", "gone", "ranges")).alias("own"))
    joined = _squeezed(rows).join(own, "id", "left").select("id", "text", "own")
    cut = joined.mapInArrow(_cut_texts(length, gram), "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return cut.withColumnRenamed("id", id_column)
