"""Alignment of two tokenizers on the same bytes.

Both tokenizers tell where in the text their tokens lie: the one in characters, the other in
bytes. These spans are coarse cuts. Where a span tells less than a token's place, because
tokens share a character or stand for single bytes of one, the decoded bytes of the tokens
place the cuts between them. Offsets at which tokens of both end cut a text into groups; the
tokens of a group are linked with one another.

No token of either vocabulary reaches across a blank that follows a visible character, so a
text falls into parts there. Parts repeat, and a store of bounded size answers for those
met before; new ones are encoded many at a time as one text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from feedmill.llm.pieces import cut_parts, in_slices, is_closed
from feedmill.llm.tables import text_of
from feedmill.session import cut

# Parts that a worker stores, as long as they have this many characters; and parts that are
# encoded as one text.
STORED_PARTS = 500_000
STORED_CHARACTERS = 16_000_000
JOINED_PARTS = 400
# Links of a group that are laid out one by one; those of larger groups are counted by id.
FEW_LINKS = 10_000
# Links that are sorted at once, and id pairs that a task counts before it hands them on.
SORTED_LINKS = 2_000_000
COUNTED_PAIRS = 1_000_000
# Counts of pairs that are broadcast at most, 16 bytes each; rarer pairs meet theirs by shuffle.
BROADCAST_PAIRS = 1 << 21

_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")


# --- tokens and cuts ---------------------------------------------------------------

def byte_level_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a visible character: bytes that are
    visible by themselves stand for themselves, the others follow from U+0100 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def byte_ends(starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each token ends, in bytes, from its span in bytes and its decoded length.

    A span that begins where the one before ends, and is not empty, is a cut; between cuts
    the decoded lengths tell.
    """
    if not len(ends):
        return ends
    clean = np.append(starts[1:] >= ends[:-1], True) & (ends > starts)
    clean[-1] = True
    reached = np.cumsum(lengths)
    last = np.maximum.accumulate(np.where(clean, np.arange(len(ends)), -1))
    # The last cut before a token, and what the tokens from there on decode to.
    before = np.concatenate([[-1], last[:-1]])
    at = np.where(before >= 0, ends[before], 0) + reached - np.where(before >= 0, reached[before], 0)
    return np.where(clean, ends, at)


def _character_offsets(text: str) -> np.ndarray:
    """The byte offset of every character, and of the end."""
    code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
    return np.concatenate([[0], np.cumsum(width)])


class Aligner:
    """Both tokenizers, and what each of their tokens decodes to."""

    def __init__(self, byte_path: str, piece_path: str):
        # The tasks are the parallelism; threads of the library would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.first = Tokenizer.from_file(byte_path)
        self.first.no_truncation()
        self.first.no_padding()
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        alphabet = byte_level_alphabet()
        size = self.first.get_vocab_size(with_added_tokens=True)
        names = [self.first.id_to_token(k) or "" for k in range(size)]
        self.first_bytes = [bytes(alphabet[c] for c in name) if all(c in alphabet for c in name) else name.encode() for name in names]
        self.second_bytes = []
        for k in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(k)
            byte = _BYTE_PIECE.match(piece) if self.second.is_byte(k) else None
            self.second_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.first_length = np.array([len(x) for x in self.first_bytes], dtype=np.int64)
        self.second_length = np.array([len(x) for x in self.second_bytes], dtype=np.int64)

    def tokens(self, text: str, encoding, pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and byte ends of both; None if the tokens of either don't decode to the
        text. ``text`` begins with the blank that the second tokenizer adds by itself."""
        raw = text.encode()
        a = encoding.ids
        spans = np.fromiter(chain.from_iterable(encoding.offsets), dtype=np.int64, count=2 * len(a)).reshape(-1, 2)
        if len(raw) != len(text):
            spans = _character_offsets(text)[spans]
        # Spans of pieces follow each other; the added blank moves them by one byte.
        b, ends = zip(*[(p.id, p.end + 1) for p in pieces], strict=True) if pieces else ((), ())
        if b"".join(map(self.first_bytes.__getitem__, a)) != raw or b"".join(map(self.second_bytes.__getitem__, b)) != raw:
            return None
        ids_a, ids_b, ends = (np.array(x, dtype=np.int64) for x in (a, b, ends))
        starts = np.concatenate([[0], ends[:-1]])
        return ids_a, byte_ends(spans[:, 0], spans[:, 1], self.first_length[ids_a]), ids_b, byte_ends(starts, ends, self.second_length[ids_b])

    def align(self, parts: list[str]) -> Iterator[Run]:
        """All parts in runs, not in their order. A part stands for a blank and itself."""
        closed, runs = [], []
        for part in parts:
            # No token reaches on behind a visible character and a blank.
            if is_closed(part):
                closed.append(part)
            else:
                runs.append([part])
        runs += [closed[k:k + JOINED_PARTS] for k in range(0, len(closed), JOINED_PARTS)]
        while runs:
            again = []
            texts = [" " + " ".join(run) for run in runs]
            for run, text, encoding in zip(runs, texts, self.first.encode_batch(texts, add_special_tokens=False), strict=True):
                found = self.tokens(text, encoding, self.second.encode(text[1:], return_type="proto").pieces)
                if found is None and len(run) > 1:
                    again += [[part] for part in run]
                elif found is None:
                    yield Run(run, None, None, None, None, None)
                else:
                    a, a_ends, b, b_ends = found
                    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
                    stops = np.cumsum([1 + len(part.encode()) for part in run])
                    yield Run(run, a, b, np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1, np.searchsorted(common, stops) + 1)
            runs = again


class Run(NamedTuple):
    """Parts that were encoded together: ids of both, how many ids of each come up to the
    end of every group, and how many groups up to the end of every part. A part whose bytes
    the tokens don't give back is alone in its run, without ids."""

    parts: list[str]
    a: np.ndarray | None
    b: np.ndarray | None
    a_cuts: np.ndarray | None
    b_cuts: np.ndarray | None
    ends: np.ndarray | None

    def links(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of id pairs (first id times ``width`` plus second id), how many links each
        stands for, and how many come up to the end of each part. A pair may be listed more
        than once."""
        a_starts, b_starts = np.concatenate([[0], self.a_cuts[:-1]]), np.concatenate([[0], self.b_cuts[:-1]])
        n_b = self.b_cuts - b_starts
        sizes = (self.a_cuts - a_starts) * n_b
        few = np.where(sizes <= FEW_LINKS, sizes, 0)
        group = np.repeat(np.arange(len(sizes)), few)
        place = np.arange(len(group)) - np.repeat(np.cumsum(few) - few, few)
        pairs = self.a[a_starts[group] + place // n_b[group]] * width + self.b[b_starts[group] + place % n_b[group]]
        times = np.ones(len(pairs), dtype=np.int64)
        large = np.nonzero(sizes > FEW_LINKS)[0]
        if len(large):
            every = [(group, pairs, times)]
            for g in large.tolist():
                ids_a, n_a = np.unique(self.a[a_starts[g]:self.a_cuts[g]], return_counts=True)
                ids_b, n_b = np.unique(self.b[b_starts[g]:self.b_cuts[g]], return_counts=True)
                codes = (ids_a[:, None] * width + ids_b).ravel()
                every.append((np.full(len(codes), g), codes, (n_a[:, None] * n_b).ravel()))
            group, pairs, times = (np.concatenate(x) for x in zip(*every, strict=True))
            order = np.argsort(group, kind="stable")
            group, pairs, times = group[order], pairs[order], times[order]
        return pairs, times, np.searchsorted(group, self.ends)

    def texts(self) -> list[str]:
        """The groups of every part as text."""
        a, b = list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        groups, i, j = [], 0, 0
        for x, y in zip(self.a_cuts.tolist(), self.b_cuts.tolist(), strict=True):
            groups.append((a[i] if x == i + 1 else ",".join(a[i:x])) + "|" + (b[j] if y == j + 1 else ",".join(b[j:y])))
            i, j = x, y
        ends = self.ends.tolist()
        return [";".join(groups[p:q]) for p, q in zip([0, *ends], ends, strict=False)]


_aligners: dict[tuple[str, str], Aligner] = {}


class Parts:
    """What is known of every part met lately, by number: the sizes, groups and links."""

    def __init__(self, paths: tuple[str, str]):
        if paths not in _aligners:
            _aligners[paths] = Aligner(*paths)
        self.aligner = _aligners[paths]
        self.width = len(self.aligner.second_bytes)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.held = 0
        # ids of both and groups of every part; where its links end; the links' codes and times.
        self.sizes, self.ends = np.empty((0, 3), dtype=np.int64), np.empty(0, dtype=np.int64)
        self.codes, self.times = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        """Align parts not met before; one without ids has no groups."""
        sizes, ends, codes, times = [self.sizes], [self.ends], [self.codes], [self.times]
        known = len(self.codes)
        for run in self.aligner.align(new):
            self.number.update(zip(run.parts, range(len(self.groups), len(self.groups) + len(run.parts)), strict=True))
            if run.a is None:
                self.groups.append(None)
                sizes.append(np.zeros((1, 3), dtype=np.int64))
                ends.append(np.array([known]))
                continue
            pairs, n, stops = run.links(self.width)
            last = run.ends - 1
            sizes.append(np.diff(np.stack([run.a_cuts[last], run.b_cuts[last], run.ends], axis=1), axis=0, prepend=0))
            ends.append(known + stops)
            known += len(pairs)
            codes.append(pairs)
            times.append(n)
            self.groups += run.texts()
        self.sizes, self.ends, self.codes, self.times = (np.concatenate(x) for x in (sizes, ends, codes, times))
        self.held += sum(map(len, new))

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The numbers of each text's parts; numbers of earlier calls may become void."""
        if len(self.groups) > STORED_PARTS or self.held > STORED_CHARACTERS:
            self.clear()
        get = self.number.get
        cuts, rows = [], []
        new: dict[str, None] = {}
        for text in texts:
            own = cut_parts(text) if text else []
            row = list(map(get, own))
            if None in row:
                new.update((part, None) for part, k in zip(own, row, strict=True) if k is None)
            cuts.append(own)
            rows.append(row)
        if new:
            self._learn(list(new))
        return [list(map(get, own)) if None in row else row for own, row in zip(cuts, rows, strict=True)]

    def block(self, texts: list[str]) -> Block:
        """The texts together."""
        rows = self.numbers(texts)
        groups = [[self.groups[k] for k in row] for row in rows]
        whole = [None not in own for own in groups]
        rows = [row if ok else [] for row, ok in zip(rows, whole, strict=True)]
        groups = [";".join(own) if ok else "" for own, ok in zip(groups, whole, strict=True)]
        counts = np.array([len(row) for row in rows], dtype=np.int64)
        part = np.fromiter(chain.from_iterable(rows), dtype=np.int64, count=int(counts.sum()))
        doc = np.repeat(np.arange(len(rows)), counts)
        begins = np.concatenate([[0], self.ends])[part]
        lengths = self.ends[part] - begins
        sums = np.zeros((len(rows), 4), dtype=np.int64)
        np.add.at(sums, doc, np.concatenate([self.sizes[part], np.zeros((len(part), 1), dtype=np.int64)], axis=1))
        docs, codes, times = [], [], []
        # So many parts at a time that their links stay few, however long a text is.
        piece = np.cumsum(lengths) // SORTED_LINKS
        for p in np.unique(piece):
            own = piece == p
            n = lengths[own]
            at = np.arange(int(n.sum())) + np.repeat(begins[own] - np.cumsum(n) + n, n)
            found = _reduced(np.repeat(doc[own], n), self.codes[at], self.times[at])
            for out, x in zip((docs, codes, times), found, strict=True):
                out.append(x)
        if len(docs) > 1:
            found = _reduced(np.concatenate(docs), np.concatenate(codes), np.concatenate(times))
        elif not docs:
            found = (np.empty(0, dtype=np.int64),) * 3
        np.add.at(sums[:, 3], found[0], found[2])
        return Block(groups, sums, *found)


class Block(NamedTuple):
    """Texts that were aligned together: the groups of each as text; n_a, n_b, n_groups and
    n_links; and its distinct id pairs: text, code and number of links, sorted."""

    groups: list[str]
    sums: np.ndarray
    docs: np.ndarray
    codes: np.ndarray
    times: np.ndarray


def _reduced(docs: np.ndarray, codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of text and code, sorted, with the sum of their times."""
    shift = max(1, int(codes.max(initial=0)).bit_length())
    key = docs << shift | codes
    if (times == 1).all():
        found, total = np.unique(key, return_counts=True)
    else:
        found, place = np.unique(key, return_inverse=True)
        total = np.zeros(len(found), dtype=np.int64)
        np.add.at(total, place, times)
    return found >> shift, found & ((1 << shift) - 1), total.astype(np.int64)


# --- the alignment -----------------------------------------------------------------

NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
BLOCK_SCHEMA = (
    "ids array<long>, " + ", ".join(f"{n} array<long>" for n in NUMBERS)
    + ", digests array<string>, groups array<string>, counts binary, codes binary, links binary, times binary")


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, byte by byte: the upper ones are mostly zero and pack well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def aligned_blocks(docs: DataFrame, paths: tuple[str, str], with_groups: bool) -> DataFrame:
    """Blocks of documents (doc_id, text), aligned once: their sums, digests and distinct id
    pairs, the pairs as places in the block's own list of codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(paths)
        for batch in batches:
            start = 0
            for some in in_slices(batch.column(1).to_pylist()):
                block = parts.block(some)
                codes, place = np.unique(block.codes, return_inverse=True)
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in block.groups]
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([batch.column(0).slice(start, len(some)).to_pylist()], pa.list_(pa.int64())),
                    **{name: pa.array([block.sums[:, k]], pa.list_(pa.int64())) for k, name in enumerate(NUMBERS)},
                    "digests": pa.array([digests], pa.list_(pa.string())),
                    "groups": pa.array([block.groups if with_groups else []], pa.list_(pa.string())),
                    "counts": pa.array([_planes(np.bincount(block.docs, minlength=len(some)))], pa.binary()),
                    "codes": pa.array([codes.astype("<i8").tobytes()], pa.binary()),
                    "links": pa.array([_planes(place)], pa.binary()), "times": pa.array([_planes(block.times)], pa.binary())})
                start += len(some)

    return docs.mapInArrow(run, BLOCK_SCHEMA)


def count_pairs(blocks: DataFrame) -> DataFrame:
    """code, n: in how many documents each id pair is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def counted() -> pa.RecordBatch:
            codes, place = np.unique(np.concatenate([c for c, _ in held] or [np.empty(0, dtype=np.int64)]), return_inverse=True)
            n = np.zeros(len(codes), dtype=np.int64)
            np.add.at(n, place, np.concatenate([n for _, n in held] or [np.empty(0, dtype=np.int64)]))
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

        for batch in batches:
            for packed, links in zip(batch.column(0), batch.column(1), strict=True):
                codes = np.frombuffer(packed.as_py(), "<i8")
                held.append((codes, np.bincount(_numbers(links.as_py()), minlength=len(codes))))
                size += len(codes)
                if size > COUNTED_PAIRS:
                    yield counted()
                    held, size = [], 0
        yield counted()

    return blocks.select("codes", "links").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def align_documents(
    docs: DataFrame, byte_path: str, piece_path: str, *, id_col: str = "doc_id", text_col: str = "text",
    broadcast: int = BROADCAST_PAIRS, with_groups: bool = False,
) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_a and n_b count the tokens of the byte-level and of the piece vocabulary; n_links all
    pairs of tokens that share a group. The count of an id pair is the number of documents
    that link it; n_best counts the links whose pair has the highest count of its first id,
    ties included, and count_sum adds up the counts of all links. groups_sha256 is the digest
    of ``a1,a2|b1;a3|b2,b3``; ``with_groups`` adds that text as ``groups``.

    Null and empty texts, and texts that the tokens of either don't decode to, have no
    tokens: zeros, and empty text unhashed. Repeated rows are documents of their own, null
    ids stay null, other columns are ignored, and an empty table gives none. Texts are
    encoded once, into stored blocks. Counts of at most ``broadcast`` pairs, the commonest,
    travel to the tasks; links of rarer pairs meet theirs by shuffle.
    """
    spark = docs.sparkSession
    width = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    blocks = cut(aligned_blocks(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")), (byte_path, piece_path), with_groups), "blocks")
    counted = cut(count_pairs(blocks), "pairs")
    first = F.floor(F.col("code") / width).cast("int")
    # One row a token of the first vocabulary at most.
    best = counted.groupBy(first.alias("a")).agg(F.max("n").alias("best"))
    most = best.toPandas()
    highest = np.zeros(int(most["a"].max()) + 1 if len(most) else 0, dtype=np.int64)
    highest[most["a"].to_numpy(dtype=np.int64)] = most["best"].to_numpy(dtype=np.int64)
    total = counted.count()
    common = counted.orderBy(F.desc("n"), "code").limit(broadcast) if total > broadcast else counted
    known = common.toPandas().sort_values("code")
    shared = spark.sparkContext.broadcast((known["code"].to_numpy(dtype=np.int64), known["n"].to_numpy(dtype=np.int64), highest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, top = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["codes"], "<i8")
                at = np.minimum(np.searchsorted(codes, own), max(0, len(codes) - 1))
                have = codes[at] == own if len(codes) else np.zeros(len(own), dtype=bool)
                n = np.where(have, counts[at] if len(codes) else 0, 0)
                is_best = have & (n == top[own // width])
                links, times, sizes = _numbers(row["links"]), _numbers(row["times"]), _numbers(row["counts"])
                doc = np.repeat(np.arange(len(sizes)), sizes)
                sums = np.zeros((2, len(sizes)), dtype=np.int64)
                np.add.at(sums[0], doc, times * is_best[links])
                np.add.at(sums[1], doc, times * n[links])
                rare, rare_times = [None] * len(sizes), [None] * len(sizes)
                unknown = ~have[links]
                for k in np.unique(doc[unknown]).tolist():
                    mine = unknown & (doc == k)
                    rare[k], rare_times[k] = own[links[mine]], times[mine]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), *(pa.array(row[name], pa.int64()) for name in NUMBERS), pa.array(sums[0]), pa.array(sums[1]),
                     pa.array(row["digests"], pa.string()), pa.array(row["groups"] or [None] * len(sizes), pa.string()),
                     pa.array(rare, pa.list_(pa.int64())), pa.array(rare_times, pa.list_(pa.int64()))],
                    names=["doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256", "groups", "rare", "times"])

    columns = ["doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else [])]
    schema = ("doc_id long, " + ", ".join(f"{n} long" for n in NUMBERS)
              + ", n_best long, count_sum long, groups_sha256 string, groups string, rare array<long>, times array<long>")
    found = blocks.mapInArrow(run, schema)
    if total <= broadcast:
        return found.select(columns)
    found = cut(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = found.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("code"), F.col("x.times").alias("times"))
    counts = counted.join(common.select("code").hint("merge"), "code", "left_anti").join(F.broadcast(best), first == F.col("a"))
    more = links.join(counts.hint("merge"), "code").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    added = found.join(more, "row", "left")
    return added.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn(
        "count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).select(columns)
