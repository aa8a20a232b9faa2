"""Removal of byte strings that repeat, by sorting suffixes.

A string of ``length`` bytes that starts at two places is found by sorting the suffixes that
start there: equal ones are neighbours. Sorting is deep-shallow: multikey quicksort orders
suffixes by their first bytes, eight at a time, down to a shallow depth; a blind trie orders
each group that is still equal there. A blind trie keeps only the places where its strings
branch, so a suffix goes down unread and is compared with one other in full.

Only suffixes that may have an equal one are sorted. Each window of ``length`` bytes has an
anchor, the least hash of the shorter grams in it, and equal windows have equal anchors at
the same place. Consecutive windows with one anchor are a bundle. Bundles whose anchor
stands nowhere else are unique; equal bundles are counted and not sorted; of the others one
of each content is taken to the task that sorts all contents of its anchor. Anchors with very many
different contents are cut into narrower bundles, whose anchor is all that their windows
share, and at last into single windows, which are counted; so no task holds an unbounded
group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedmill.llm.pieces import in_slices
from feedmill.llm.tables import task_count, text_of
from feedmill.session import cut

LENGTH = 400
# Windows of a narrower bundle.
NARROW = 16
# Different contents of one anchor that a task sorts together, and bytes that it sorts at once.
MOST_CONTENTS = 4096
SORTED_BYTES = 4 << 20
# Bytes that multikey quicksort compares before the blind tries take over.
SHALLOW = 32
# Window starts that are hashed at once.
SLICE = 1 << 17
# Texts are picked by a broadcast of their hashes only while these take less than this.
BROADCAST_BYTES = 32 << 20

_TABLE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.random.default_rng(12).integers(0, 1 << 62, 24, dtype=np.uint64) * np.uint64(4) + np.uint64(3)


# --- anchors and bundles -------------------------------------------------------------

def gram_length(length: int) -> int:
    """Bytes of a gram: a power of two, a third of ``length`` or a little less."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the gram at each place."""
    x = _TABLE[data]
    step, k = 1, 0
    while step < gram:
        x = x[:-step] * _ODD[k] + x[step:]
        step, k = 2 * step, k + 1
    x = x ^ (x >> np.uint64(31))
    x *= _ODD[20]
    x ^= x >> np.uint64(29)
    return x


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive numbers."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have:]) if have < width else x


def anchor_runs(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: where each begins, its anchor, the anchor's hash."""
    gram = gram_length(length)
    width = length - gram + 1
    starts, anchors, hashes = [], [], []
    for first in range(0, len(data) - length + 1, SLICE):
        stop = min(first + SLICE, len(data) - length + 1)
        h = gram_hashes(data[first:stop + length - 1], gram)
        # The leftmost of equal hashes is the anchor.
        ordered = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        own = (_sliding_least(ordered, width) & np.uint64((1 << 20) - 1)).astype(np.int64)
        new = np.nonzero(np.concatenate([[True], own[1:] != own[:-1]]))[0]
        if anchors and anchors[-1][-1] == first + own[0]:
            new = new[1:]
        starts.append(first + new)
        anchors.append(first + own[new])
        hashes.append(h[own[new]])
    if not starts:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty.astype(np.uint64)
    return np.concatenate(starts), np.concatenate(anchors), np.concatenate(hashes)


def _name(content: bytes | memoryview) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True)


def pack_place(low: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First window, number of windows, and the anchor's distance from the first, in one number."""
    return low.astype(np.int64) << 32 | size.astype(np.int64) << 16 | at.astype(np.int64)


def unpack_place(place: np.ndarray | int) -> tuple:
    return place >> 32, place >> 16 & 0xFFFF, place & 0xFFFF


def bundles(texts: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Key (the anchor's hash), node (name of the content) and place of the bundles of each text."""
    joined = b"".join(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    runs, anchors, hashes = anchor_runs(np.frombuffer(joined, np.uint8), length)
    # Windows that lie in one text: runs are cut at its first and behind its last one.
    long = sizes >= length
    cuts = np.unique(np.concatenate([runs, begins[long], ends[long] - length + 1]))
    owner = np.searchsorted(ends, cuts, side="right")
    inside = owner < len(texts)
    inside[inside] = cuts[inside] <= ends[owner[inside]] - length
    stops = np.append(cuts[1:], len(joined))[inside]
    lows, owner = cuts[inside], owner[inside]
    run = np.searchsorted(runs, lows, side="right") - 1
    counts = stops - lows
    view = memoryview(joined)
    nodes = np.array([_name(view[a:b]) for a, b in zip(lows.tolist(), (stops + length - 1).tolist(), strict=True)], dtype=np.int64)
    keys, places = hashes[run].view(np.int64), pack_place(lows - begins[owner], counts, anchors[run] - lows)
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(keys[a:b], nodes[a:b], places[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def narrow_bundles(content: bytes, size: int, at: int, length: int, width: int) -> Iterator[tuple[int, int, int]]:
    """The bundle's windows in bundles of at most ``width``, cut at multiples of it before
    the anchor: key (hash of the bytes that all windows of such a bundle share), node, place."""
    low = 0
    while low < size:
        number = (at - low) // width
        stop = min(size, at - number * width + 1)
        shared = content[at - number * width:at - (number + 1) * width + 1 + length]
        key = int.from_bytes(hashlib.blake2b(shared, digest_size=8, salt=b"key").digest(), "little", signed=True)
        node = _name(content[low:stop - 1 + length])
        yield (node if width == 1 else key), node, low << 32 | (stop - low) << 16 | (at - low)
        low = stop


# --- suffix sorting ------------------------------------------------------------------

def _word(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Eight bytes at each place as a number that sorts like them."""
    return data[places[:, None] + np.arange(8)].view(">u8").ravel().astype(np.uint64)


def multikey_quicksort(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first ``depth`` bytes, and the group of each in that
    order: equal ones share a group, groups ascend.

    All segments of the sort are parted in one step: each into less than, equal to and more
    than its pivot; only the equal part moves on by eight bytes. ``data`` has ``depth`` bytes
    behind every start.
    """
    order = np.arange(len(starts))
    group = np.zeros(len(starts), dtype=np.int64)
    done = np.zeros(len(starts), dtype=np.int64)
    while True:
        first = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.empty(0, bool)
        begins = np.nonzero(first)[0]
        sizes = np.diff(np.append(begins, len(group)))
        active = np.repeat(sizes > 1, sizes) & (done < depth)
        at = np.nonzero(active)[0]
        if not len(at):
            return order, np.cumsum(first) - 1
        word = _word(data, starts[order[at]] + done[at])
        own = np.concatenate([[True], group[at][1:] != group[at][:-1]])
        heads = np.nonzero(own)[0]
        pivots = word[heads + np.diff(np.append(heads, len(at))) // 2]
        pivot = np.repeat(pivots, np.diff(np.append(heads, len(at))))
        side = (word > pivot).astype(np.int64) - (word < pivot) + 1
        moved = np.lexsort((side, group[at]))
        order[at], side, depth_now = order[at[moved]], side[moved], done[at[moved]]
        done[at] = np.where(side == 1, depth_now + 8, depth_now)
        # Three groups in the place of one.
        group *= 3
        group[at] += side
        group = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))


class BlindTrie:
    """Orders suffixes that agree in their first ``base`` bytes, by at most ``limit`` bytes."""

    def __init__(self, data: bytes, base: int, limit: int):
        self.data, self.base, self.limit = data, base, limit
        self.root: list | None = None

    def _common(self, a: int, b: int) -> int:
        """How many of the first ``limit`` bytes agree."""
        x, y = self.data[a + self.base:a + self.limit], self.data[b + self.base:b + self.limit]
        if x == y:
            return self.limit
        differ = int.from_bytes(x) ^ int.from_bytes(y)
        return self.limit - (differ.bit_length() + 7) // 8

    def insert(self, number: int, start: int) -> None:
        """A leaf is [limit, start, numbers of equal suffixes]; a branch [depth, children by byte]."""
        if self.root is None:
            self.root = [self.limit, start, [number]]
            return
        data, node = self.data, self.root
        path = []
        while len(node) == 2:
            byte = data[start + node[0]]
            path.append((node, byte))
            node = node[1].get(byte) or next(iter(node[1].values()))
        same = self._common(start, node[1])
        if same == self.limit:
            node[2].append(number)
            return
        other = data[node[1] + same]
        leaf = [self.limit, start, [number]]
        above = [(branch, byte) for branch, byte in path if branch[0] <= same]
        if above and above[-1][0][0] == same:
            above[-1][0][1][data[start + same]] = leaf
            return
        below = above[-1][0][1][above[-1][1]] if above else self.root
        branch = [same, {other: below, data[start + same]: leaf}]
        if above:
            above[-1][0][1][above[-1][1]] = branch
        else:
            self.root = branch

    def ordered(self) -> Iterator[tuple[int, int]]:
        """Numbers in order, each with how many bytes it has in common with the one before."""
        stack = [(self.root, self.base)] if self.root else []
        while stack:
            node, common = stack.pop()
            if len(node) == 3:
                for number in node[2]:
                    yield number, common
                    common = self.limit
            else:
                children = [node[1][byte] for byte in sorted(node[1])]
                stack += [(child, node[0]) for child in reversed(children[1:])]
                stack.append((children[0], common))


def sort_suffixes(data: bytes, starts: np.ndarray, limit: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first ``limit`` bytes, and how many bytes each has in
    common with the one before; neighbours that part in the shallow bytes have 0.

    ``data`` has ``limit`` bytes behind every start, and eight more at its end.
    """
    depth = min(shallow, limit // 8 * 8)
    order, group = multikey_quicksort(np.frombuffer(data, np.uint8), starts, depth)
    common = np.zeros(len(order), dtype=np.int64)
    begins = np.nonzero(np.concatenate([[True], group[1:] != group[:-1]]))[0] if len(group) else np.empty(0, np.int64)
    ends = np.append(begins[1:], len(group))
    open_groups = ends - begins > 1
    for a, b in zip(begins[open_groups].tolist(), ends[open_groups].tolist(), strict=True):
        trie = BlindTrie(data, depth, limit)
        numbers = order[a:b].tolist()
        for number, start in zip(numbers, starts[numbers].tolist(), strict=True):
            trie.insert(number, start)
        placed = list(trie.ordered())
        order[a:b] = [number for number, _ in placed]
        common[a + 1:b] = [same for _, same in placed[1:]]
    return order, common


def longest_common(data: bytes, starts: np.ndarray, limit: int) -> np.ndarray:
    """How many bytes each suffix has in common with the nearest one, at most ``limit``."""
    order, common = sort_suffixes(data, starts, limit)
    out = np.zeros(len(starts), dtype=np.int64)
    out[order] = np.maximum(common, np.append(common[1:], 0))
    return out


def repeated_windows(contents: list[tuple[bytes, int, int]], length: int, width: int = NARROW) -> list[np.ndarray]:
    """For each content (bytes, number of windows, place of the anchor) which of its windows
    is a window of another one.

    Windows are taken ``width`` at a time, a span. If the suffix at the last of them parts from
    all others within the bytes that they all share, none is repeated. If the suffix at the
    first agrees with another up to the last one's end, all are. Else each is sorted by itself.
    """
    # A byte that no text holds stands behind every content.
    behind = b"\xff" * (width + 8)
    data = behind.join([content for content, _, _ in contents] + [b""]) + b"\xff" * length
    bases = np.concatenate([[0], np.cumsum([len(c) + len(behind) for c, _, _ in contents])])
    marked = [np.zeros(size, dtype=bool) for _, size, _ in contents]
    spans = []
    for k, (_, size, at) in enumerate(contents):
        low = 0
        while low < size:
            number = (at - low) // width
            stop = min(size, at - number * width + 1)
            spans.append((k, low, stop, at - number * width))
            low = stop
    span = np.array(spans, dtype=np.int64).reshape(-1, 4)
    shared = length - width + 1
    # Spans whose shared bytes are equal are of one class; others have no window in common.
    order, common = sort_suffixes(data, bases[span[:, 0]] + span[:, 3], shared) if shared >= 8 else (np.arange(len(span)), np.full(len(span), shared))
    span, kind = span[order], np.cumsum(common < max(shared, 0))
    several = np.bincount(kind, minlength=1)[kind] > 1
    span, kind = span[several], kind[several]
    reach = longest_common(data, bases[span[:, 0]] + span[:, 1], length + width - 1)
    whole = reach >= span[:, 2] - span[:, 1] - 1 + length
    for k, low, stop, _ in span[whole].tolist():
        marked[k][low:stop] = True
    # The rest may also share a window with a span that is repeated as a whole: one of each
    # content of those is sorted with them.
    unsure = np.isin(kind, kind[~whole])
    rest, met = [], set()
    for (k, low, stop, _), own, all_of_it in zip(span[unsure].tolist(), kind[unsure].tolist(), whole[unsure].tolist(), strict=True):
        if all_of_it:
            content = (own, contents[k][0][low:stop - 1 + length])
            if content in met:
                continue
            met.add(content)
        rest += [(k, s) for s in range(low, stop)]
    owner, window = np.array(rest, dtype=np.int64).reshape(-1, 2).T
    found = longest_common(data, bases[owner] + window, length) >= length
    for k, s in zip(owner[found].tolist(), window[found].tolist(), strict=True):
        marked[k][s] = True
    return marked


# --- Spark ---------------------------------------------------------------------------

def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last of every run of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    yield from zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True)


def _sorted_marks(contents: DataFrame, length: int) -> DataFrame:
    """key, node, first, last: windows of the contents that another content has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes, int, int]] = []
        size, last = 0, None

        def flush() -> pa.RecordBatch:
            out = []
            for (key, node, _, _, _), marks in zip(held, repeated_windows([h[2:] for h in held], length), strict=True):
                out += [(key, node, a, b) for a, b in _runs(marks)]
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "node", "first", "last"])

        for batch in batches:
            for key, node, place, content in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if size > SORTED_BYTES and key != last:
                    yield flush()
                    held, size = [], 0
                _, windows, at = unpack_place(place)
                held.append((key, node, content, windows, at))
                size += len(content)
                last = key
        if held:
            yield flush()

    parted = contents.select("key", "node", "place", "content").repartition(task_count(contents.sparkSession), "key").sortWithinPartitions("key", "node")
    return parted.mapInArrow(run, "key long, node long, first long, last long")


def _narrower(contents: DataFrame, length: int, width: int) -> DataFrame:
    """The contents' windows in narrower bundles, owned by the contents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, node, n, place, content in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                _, size, at = unpack_place(place)
                out += [(key, node, own_key, own_node, n, own) for own_key, own_node, own in narrow_bundles(content, size, at, length, width)]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["o1", "o2", "key", "node", "n", "place"])

    return contents.select("key", "node", "n", "place", "content").mapInArrow(run, "o1 long, o2 long, key long, node long, n long, place long")


def _once(sources: DataFrame) -> DataFrame:
    """The sources (o1, o2, content) with each owner once a task, so that copies don't travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            owners = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            new = []
            for owner in owners:
                new.append(owner not in seen)
                seen.add(owner)
            yield batch.filter(pa.array(new, pa.bool_()))

    return sources.mapInArrow(run, sources.schema)


def _contents(sources: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """key, node, n, place, large, content of the bundles ``asked`` of their owners (o1, o2)."""
    lists = asked.groupBy("o1", "o2").agg(F.collect_list(F.struct("key", "node", "n", "place", "large")).alias("asked"))
    lists = cut(lists, "asked")
    if lists.count() * 16 <= BROADCAST_BYTES:
        sources = sources.join(F.broadcast(lists.select("o1", "o2")), ["o1", "o2"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, wanted in zip(batch.column(0), batch.column(1), strict=True):
                source, rows = source.as_py(), wanted.as_py()
                content = []
                for row in rows:
                    low, size, at = unpack_place(row["place"])
                    content.append(source[low:low + size - 1 + length])
                    # From here on the content stands by itself.
                    row["place"] = size << 16 | at
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([r[c] for r in rows], t) for c, t in (("key", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("place", pa.int64()), ("large", pa.bool_()))),
                     pa.array(content, pa.binary())], names=["key", "node", "n", "place", "large", "content"])

    met = _once(sources).join(lists, ["o1", "o2"]).select("content", "asked")
    found = met.mapInArrow(run, "key long, node long, n long, place long, large boolean, content binary")
    return cut(found.dropDuplicates(["key", "node"]), "contents")


def repeated_starts(pieces: DataFrame, sources: DataFrame, length: int, widths: list[int], most: int) -> DataFrame:
    """o1, o2, first, last: the windows of each owner that start anywhere else too.

    ``pieces`` are bundles: o1, o2 (the owner), key, node, n (how often the owner is there),
    place. ``sources`` has the owners' bytes: o1, o2, content. ``widths`` are those that
    anchors with more than ``most`` contents are cut to, the last being 1.
    """
    # Stored, so that the join sees two plain shuffles and can split a key with very many pieces.
    keys = cut(pieces.groupBy("key").agg(F.sum("n").alias("total"), (F.min("node") != F.max("node")).alias("mixed")).where("total > 1").select("key", "mixed"), "keys")
    again = cut(pieces.join(keys, "key"), "again")
    low = F.shiftright("place", 32)
    size = F.shiftright("place", 16).bitwiseAND(0xFFFF)
    alike = again.where("NOT mixed").select("o1", "o2", low.alias("first"), (low + size - 1).alias("last"))
    nodes = cut(again.where("mixed").groupBy("key", "node").agg(F.sum("n").alias("n"), F.min(F.struct("o1", "o2", "place")).alias("at")), "nodes")
    # Only large anchors are met, so that no task gathers the contents of one.
    crowded = cut(nodes.groupBy("key").agg(F.count("*").alias("contents")).where(F.col("contents") > most).select("key", F.lit(True).alias("large")), "crowded")
    if crowded.count() * 16 <= BROADCAST_BYTES:
        crowded = F.broadcast(crowded)
    asked = nodes.join(crowded, "key", "left").select(
        "at.o1", "at.o2", "key", "node", "n", "at.place", F.coalesce("large", F.lit(False)).alias("large"))
    contents = _contents(sources, asked, length)
    # Equal contents repeat as a whole, the others by what they share.
    marks = contents.where("n > 1").select("key", "node", F.lit(0).cast("long").alias("first"), (F.shiftright("place", 16).bitwiseAND(0xFFFF) - 1).alias("last"))
    marks = marks.unionByName(_sorted_marks(contents.where("NOT large"), length))
    large = contents.where("large")
    if widths and not large.isEmpty():
        parts = _narrower(large, length, widths[0])
        own = large.select(F.col("key").alias("o1"), F.col("node").alias("o2"), "content")
        marks = marks.unionByName(repeated_starts(parts, own, length, widths[1:], most).select(
            F.col("o1").alias("key"), F.col("o2").alias("node"), "first", "last"))
    mixed = again.where("mixed AND n = 1").join(cut(marks, "marks"), ["key", "node"])
    return alike.unionByName(mixed.select("o1", "o2", (low + F.col("first")).alias("first"), (low + F.col("last")).alias("last")))


def _described(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, o1, o2 (name of the text), n_bytes, sha256 and the bundles of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for some in in_slices(batch.column(3).to_pylist()):
                raw = [t.encode() for t in some]
                found = bundles(raw, length)
                offsets = np.concatenate([[0], np.cumsum([len(f[0]) for f in found])]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([f[k] for f in found]))) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(start, len(some)) for k in range(3)), pa.array([len(x) for x in raw], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in raw]), *lists],
                    names=["doc_id", "o1", "o2", "n_bytes", "sha256", "keys", "nodes", "places"])
                start += len(some)

    return docs.mapInArrow(
        run, "doc_id long, o1 long, o2 long, n_bytes long, sha256 string, keys array<long>, nodes array<long>, places array<long>")


def _cut_texts(texts: DataFrame, ranges: DataFrame, length: int) -> DataFrame:
    """row, n_removed, n_spans, kept_sha256, kept of the texts with ranges (o1, o2, row, first, last) of repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for content, own in zip(batch.column(1), batch.column(2), strict=True):
                content = content.as_py()
                change = np.zeros(len(content) + 1, dtype=np.int64)
                for r in own.as_py():
                    change[r["first"]] += 1
                    change[r["last"] + length] -= 1
                gone = np.cumsum(change[:-1]) > 0
                kept = np.frombuffer(content, np.uint8)[~gone].tobytes()
                out.append((int(gone.sum()), sum(1 for _ in _runs(gone)), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.string()), pa.array(columns[3], pa.binary())],
                names=["row", "n_removed", "n_spans", "kept_sha256", "kept"])

    lists = cut(ranges.groupBy("o1", "o2", "row").agg(F.collect_set(F.struct("first", "last")).alias("ranges")), "ranges")
    if lists.count() * 16 <= BROADCAST_BYTES:
        texts = texts.join(F.broadcast(lists.select("o1", "o2")), ["o1", "o2"], "left_semi")
    met = texts.join(lists, ["o1", "o2"]).select("row", "content", "ranges")
    return met.mapInArrow(run, "row long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, most: int = MOST_CONTENTS, with_kept: bool = False,
) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte goes that lies in a string of ``length`` bytes (3 to 20,000) which starts
    anywhere else too, in the same text or another; strings overlap, and are judged on the
    texts as given. n_spans counts the runs of removed bytes; ``with_kept`` adds the bytes
    left, as ``kept``.

    A null text is empty. Repeated rows and equal texts are all removed where they have
    ``length`` bytes, none is spared; shorter texts stay. Null ids stay null, other columns
    are ignored, an empty table gives no rows.
    """
    if not 3 <= length <= 20_000:
        raise ValueError("length must be from 3 to 20000")
    text = text_of(text_col)
    o1, o2 = F.xxhash64(text).alias("o1"), F.xxhash64(F.lit(1), text).alias("o2")
    described = cut(_described(docs.select(F.col(id_col).cast("long").alias("doc_id"), o1, o2, text.alias("text")), length).withColumn(
        "row", F.monotonically_increasing_id()), "described")
    copies = cut(described.groupBy("o1", "o2").agg(F.count("*").alias("copies"), F.min("row").alias("row")), "copies")
    # One row of each text stands for all; more than two copies tell no more than two.
    chosen = described.join(copies.select("row", F.least("copies", F.lit(2)).cast("long").alias("n")), "row")
    pieces = chosen.select("o1", "o2", "n", F.explode(F.arrays_zip("keys", "nodes", "places")).alias("b")).select(
        "o1", "o2", F.col("b.keys").alias("key"), F.col("b.nodes").alias("node"), "n", F.col("b.places").alias("place"))
    texts = docs.select(o1, o2, text.cast("binary").alias("content"))
    ranges = repeated_starts(pieces, texts, length, [NARROW, 1], most)
    single = copies.where("copies = 1")
    found = _cut_texts(texts, ranges.join(single.drop("copies"), ["o1", "o2"]), length)
    if not with_kept:
        found = found.drop("kept")
    gone = F.col("copies").isNull() & (F.col("n_bytes") >= length)
    columns = [
        "doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256")]
    whole = described.select("row", "doc_id", "o1", "o2", "n_bytes", "sha256")
    if with_kept:
        # Untouched texts are read again, beside the cut ones.
        whole = whole.join(texts.dropDuplicates(["o1", "o2"]), ["o1", "o2"])
        columns.append(F.when(gone, F.lit(b"")).otherwise(F.coalesce("kept", "content")).alias("kept"))
    # By row, not by text, so that equal texts spread over all tasks: rows without a match have copies.
    return whole.join(single.select("row", "copies"), "row", "left").join(found, "row", "left").select(columns)
