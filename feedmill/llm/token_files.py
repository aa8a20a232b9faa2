"""Token-id files as directly addressable codes.

A shard holds the ids of consecutive documents. Every id is split into chunks of eight
bits. Level one keeps the lowest chunk of all ids; a bitmap marks the ids that go on;
level two keeps the next chunk of those, and so on. A directory of set bits before every
512-bit block makes the rank of a position one addition and a popcount, so any id is
found from its position without decoding anything before it.

Shards are rows of a Parquet table written by Spark, hence valid on any store that Spark
reaches: ``part`` and ``seq`` order them, ``content`` holds one shard file.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, compress, repeat
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from feedmill.llm.pieces import VISIBLE, cut_parts, id_type, is_closed
from feedmill.llm.tables import task_count, text_of

MAGIC = b"DACTOK1\0"
CHUNK_BITS = 8
BLOCK_BITS = 512
# A shard is closed once it holds this many ids.
SHARD_IDS = 4_000_000
# Parts that a worker stores, as long as they have this many characters; and parts that are
# encoded as one text.
STORED_PARTS = 800_000
STORED_CHARACTERS = 24_000_000
JOINED_PARTS = 400
# Bytes of the texts that are split at once.
SLICE_BYTES = 4_000_000
# Characters of a text that place it among texts of its id.
RANGE_CHARACTERS = 128

_HEADER = struct.Struct("<8sQQB")
_encoders: dict[str, PartIds] = {}


# --- codes -----------------------------------------------------------------------

def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, continuation bitmap and rank directory of every level; one level at least."""
    levels = []
    rest = ids.astype(np.uint64)
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        padded = np.zeros(-(-max(len(bits), 1) // (BLOCK_BITS // 8)) * (BLOCK_BITS // 8), dtype=np.uint8)
        padded[: len(bits)] = bits
        counts = np.bitwise_count(padded).reshape(-1, BLOCK_BITS // 8).sum(axis=1, dtype=np.uint64)
        directory = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(counts, dtype=np.uint64)])
        levels.append(((rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8), padded, directory))
        if not goes_on.any():
            return levels
        rest = more[goes_on]


def pack_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One shard file: header, document directory, levels."""
    levels = encode_levels(ids)
    known = np.array([doc is not None for doc in doc_ids], dtype=np.uint8)
    out = [
        _HEADER.pack(MAGIC, len(doc_ids), len(ids), len(levels)),
        known.tobytes(),
        np.array([doc or 0 for doc in doc_ids], dtype="<i8").tobytes(),
        np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype("<i8").tobytes(),
    ]
    for chunks, bitmap, directory in levels:
        out.append(struct.pack("<QQQ", len(chunks), len(bitmap), len(directory)))
        out += [chunks.tobytes(), bitmap.tobytes(), directory.astype("<u8").tobytes()]
    return b"".join(out)


class Shard:
    """A shard file opened for reading; nothing is decoded until asked for."""

    def __init__(self, content: bytes):
        magic, docs, self.n_ids, levels = _HEADER.unpack_from(content, 0)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = _HEADER.size
        known = np.frombuffer(content, np.uint8, docs, at)
        at += docs
        numbers = np.frombuffer(content, "<i8", docs, at)
        at += 8 * docs
        self.starts = np.frombuffer(content, "<i8", docs + 1, at)
        at += 8 * (docs + 1)
        self.doc_ids = [int(n) if k else None for n, k in zip(numbers, known, strict=True)]
        self.levels = []
        for _ in range(levels):
            chunks, bits, blocks = struct.unpack_from("<QQQ", content, at)
            at += 24
            self.levels.append((np.frombuffer(content, np.uint8, chunks, at),
                                np.frombuffer(content, np.uint8, bits, at + chunks),
                                np.frombuffer(content, "<u8", blocks, at + chunks + bits)))
            at += chunks + bits + 8 * blocks

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, position: int) -> int:
        """Set bits before ``position``."""
        block = position // BLOCK_BITS
        first, last = block * (BLOCK_BITS // 8), position // 8
        inside = int(np.bitwise_count(bitmap[first:last]).sum())
        part = int(bitmap[last]) & ((1 << (position % 8)) - 1) if position % 8 else 0
        return int(directory[block]) + inside + part.bit_count()

    def token(self, position: int) -> int:
        """The id at a position, by one rank a level."""
        if not 0 <= position < self.n_ids:
            raise IndexError(position)
        value, shift = 0, 0
        for chunks, bitmap, directory in self.levels:
            value |= int(chunks[position]) << shift
            if not bitmap[position // 8] >> (position % 8) & 1:
                break
            position = self._rank(bitmap, directory, position)
            shift += CHUNK_BITS
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to before ``stop``; reads only their chunks."""
        chunks, bitmap, directory = self.levels[0]
        out = chunks[start:stop].astype(np.uint32)
        places = np.arange(stop - start)
        first, shift = start, 0
        for level in range(1, len(self.levels)):
            if not len(places):
                break
            low, high = first // 8, -(-(first + len(places)) // 8)
            bits = np.unpackbits(bitmap[low:high], bitorder="little")[first - 8 * low:][: len(places)].astype(bool)
            first = self._rank(bitmap, directory, first)
            places = places[bits]
            shift += CHUNK_BITS
            chunks, bitmap, directory = self.levels[level]
            out[places] |= chunks[first:first + len(places)].astype(np.uint32) << shift
        return out

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Document id, position of its first id in the shard, its ids."""
        for k, doc in enumerate(self.doc_ids):
            yield doc, int(self.starts[k]), self.slice(int(self.starts[k]), int(self.starts[k + 1]))


# --- encoding --------------------------------------------------------------------

class PartIds:
    """Encodes texts by the library, each new part once: the ids of all parts met lately
    stand in one array, and a text is gathered from the numbers of its parts."""

    def __init__(self, tokenizer_path: str):
        # The tasks are the parallelism; threads of the library would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = id_type(self.tokenizer.get_vocab_size(with_added_tokens=True))
        added = {number: token.content for number, token in self.tokenizer.get_added_tokens_decoder().items()}
        names = [self.tokenizer.id_to_token(k) or "" for k in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        # Byte-level vocabularies write a byte as one letter, added tokens stand as they are.
        self.lengths = np.array([len(added[k].encode()) if k in added else len(name) for k, name in enumerate(names)], dtype=np.int64)
        # Added tokens that take blanks with them could reach across parts.
        self.whole = any(" " in t.content or t.lstrip or t.rstrip for t in self.tokenizer.get_added_tokens_decoder().values())
        self.clear()

    def clear(self) -> None:
        # The first part of a text, which has no blank, is known by a tuple.
        self.number: dict[str | tuple[str], int] = {}
        self.ids, self.ends = np.empty(0, dtype=self.kind), np.empty(0, dtype=np.int64)
        self.held = 0

    def _learn(self, heads: list[str], parts: list[str]) -> None:
        """Encode parts not met before, many as one text: no token crosses from part to part,
        and the bytes of the tokens tell whose they are."""
        closes = by_last(parts, is_closed)
        closed = list(compress(parts, closes))
        runs = [closed[k:k + JOINED_PARTS] for k in range(0, len(closed), JOINED_PARTS)] + [[part] for part in compress(parts, map(not_, closes))]
        texts = heads + [" " + " ".join(run) for run in runs]
        ids, ends, known = [self.ids], [self.ends], len(self.ids)
        for k, encoding in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            own = np.array(encoding.ids, dtype=self.kind)
            names: list = [(heads[k],)] if k < len(heads) else runs[k - len(heads)]
            if len(names) == 1:
                stops = np.array([len(own)])
            else:
                reached = np.cumsum(self.lengths[own])
                places = np.cumsum(list(map(len, map(str.encode, names)))) + np.arange(1, len(names) + 1)
                stops = np.searchsorted(reached, places) + 1
                if reached[-1] != places[-1] or (reached[stops - 1] != places).any():
                    raise ValueError("the tokens of this vocabulary are not the bytes of the text")
            self.number.update(zip(names, range(len(self.number), len(self.number) + len(names)), strict=True))
            ids.append(own)
            ends.append(known + stops)
            known += len(own)
        self.ids, self.ends = np.concatenate(ids), np.concatenate(ends)
        self.held += sum(map(len, parts)) + sum(map(len, heads))

    def _numbers(self, keys: list) -> np.ndarray:
        """The numbers of known parts; -1 for the others."""
        return np.fromiter(map(self.number.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has.

        Texts are split and their parts told apart by Arrow; only distinct parts become
        objects. The few texts with blanks that are no cuts are cut by themselves.
        """
        if len(self.number) > STORED_PARTS or self.held > STORED_CHARACTERS:
            self.clear()
        split = pc.split_pattern(texts, " ")
        edges = split.offsets.to_numpy().astype(np.int64)
        edges -= edges[0]
        coded = split.flatten().dictionary_encode()
        code, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False)
        first, last = edges[:-1], edges[1:] - 1
        # No cut behind a part that is empty or ends in anything but a visible character.
        ends_well = np.array(by_last(words.tolist(), lambda last: VISIBLE.match(last) is not None), dtype=bool)
        filled = words.astype(bool)
        bad = ~ends_well[code]
        bad[last] = ~filled[code[last]] & (last > first)
        odd = np.add.reduceat(bad, first) > 0 if len(first) else np.empty(0, dtype=bool)
        if self.whole:
            odd[:] = True
        cuts = {k: [texts[k].as_py()] if self.whole else cut_parts(texts[k].as_py()) for k in np.flatnonzero(odd).tolist()}

        text = np.repeat(np.arange(len(first)), edges[1:] - edges[:-1])
        plain = ~odd[text]
        inner = plain.copy()
        inner[first] = False
        of_word, of_head = np.full(len(words), -1, dtype=np.int64), np.full(len(words), -1, dtype=np.int64)
        starts = np.unique(code[first[~odd]])
        heads = [(word,) for word in words[starts]] + [(own[0],) for own in cuts.values()]
        used = np.zeros(len(words), dtype=bool)
        used[code[inner]] = True
        places = np.flatnonzero(used)
        of_word[places] = self._numbers(words[places].tolist())
        unknown = places[of_word[places] < 0]
        new_heads = dict.fromkeys(h[0] for h in heads if h not in self.number)
        new_parts = dict.fromkeys(chain(words[unknown].tolist(), (part for own in cuts.values() for part in own[1:] if part not in self.number)))
        if new_heads or new_parts:
            self._learn(list(new_heads), list(new_parts))
        of_word[unknown] = self._numbers(words[unknown].tolist())
        of_head[starts] = self._numbers([(word,) for word in words[starts]])
        part = np.where(inner, of_word[code], of_head[code])
        counts = edges[1:] - edges[:-1]
        if cuts:
            # Their own parts in the place of those at all blanks.
            pieces, at = [], 0
            for k, own in cuts.items():
                pieces += [part[at:edges[k]], self._numbers([(own[0],), *own[1:]])]
                counts[k], at = len(own), edges[k + 1]
            part = np.concatenate([*pieces, part[at:]])
        begins = np.concatenate([[0], self.ends])[part]
        lengths = self.ends[part] - begins
        at = np.arange(int(lengths.sum())) + np.repeat(begins - np.cumsum(lengths) + lengths, lengths)
        totals = np.diff(np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])])
        return self.ids[at], totals


def by_last(parts: list[str], holds: Callable[[str], bool]) -> list[bool]:
    """Whether it holds of the last character of each part, asked once a character; not of empty parts."""
    lasts = [part[-1:] for part in parts]
    found = {last: bool(last) and holds(last) for last in set(lasts)}
    return list(map(found.__getitem__, lasts))


def text_slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive texts of about ``size`` bytes; a longer one is a slice of its own."""
    reached = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = reached[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(reached, before + size, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


def library_encoder(tokenizer_path: str) -> PartIds:
    """The encoder of a tokenizers file, one a process."""
    if tokenizer_path not in _encoders:
        _encoders[tokenizer_path] = PartIds(tokenizer_path)
    return _encoders[tokenizer_path]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` behind each text."""
    if end_id is None:
        return ids, counts
    out = np.full(len(ids) + len(counts), end_id, dtype=np.promote_types(ids.dtype, np.min_scalar_type(end_id)))
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out, counts + 1


SHARD_SCHEMA = "part int, seq int, n_docs long, n_ids long, content binary"


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None, *, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every text and write the ids as shards in ascending id order to ``path``.

    Nulls: a null text is empty, rows with a null id come first. Rows that repeat are all
    kept; equal ids are ordered by their text, whatever the number of tasks. Without rows
    the table is empty. Other columns are ignored. Texts are spread by ranges of ids and
    of how texts begin, so any number of rows may share a source or an id.
    """
    spark = docs.sparkSession
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
        .repartitionByRange(task_count(spark), F.col("doc_id").asc_nulls_first(), F.substring("text", 1, RANGE_CHARACTERS))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer_path)
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                 "n_docs": pa.array([len(doc_ids)], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()),
                 "content": pa.array([pack_shard(doc_ids, np.concatenate(lengths), ids)], pa.binary())})

        for batch in batches:
            own, start = batch.column(0).to_pylist(), 0
            for run in text_slices(batch.column(1)):
                ids, counts = with_end(*encoder.encode(run), end_id)
                doc_ids += own[start:start + len(run)]
                start += len(run)
                held.append(ids)
                lengths.append(counts)
                size += len(ids)
                if size >= SHARD_IDS:
                    yield close()
                    doc_ids, held, lengths, size, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield close()

    # One shard a row group at most: a reader of one shard then holds one in memory.
    ordered.mapInArrow(shards, SHARD_SCHEMA).write.option("parquet.block.size", 8 << 20).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents read back: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of the ids as little-endian 32-bit integers)."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard(batch.column(2)[k].as_py())
                rows = [(doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc, start, ids in shard.documents()]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[k].as_py()] * len(rows), pa.int32()),
                     pa.array([batch.column(1)[k].as_py()] * len(rows), pa.int32()),
                     *(pa.array(c, pa.int64()) for c in columns)],
                    names=["part", "seq", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    found = shards.select("part", "seq", "content").mapInArrow(
        documents, "part int, seq int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    # One row a shard, some millions of ids each: the running sum is over few rows.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    return found.join(offsets, ["part", "seq"]).select(
        "doc_id", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
