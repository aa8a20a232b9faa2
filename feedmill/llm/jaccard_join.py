"""N-gram Jaccard join by filters under several global orders.

A document is the set of its word n-grams, hashed to 64 bits. Documents with one set are
one node. All n-grams are put into several global orders: rare ones first, equally rare
ones by another hash in each order. If two sets are similar enough, their first common
n-gram stands, in every order, so early in both that enough n-grams are left for the
overlap that the threshold asks for. So only n-grams of these prefixes make candidates, a
candidate must share a prefix n-gram under every order, and candidates are then verified
on the whole sets. An n-gram that a single node holds makes no candidate and only takes a
place in the prefix, which leaves very little to join.

No group of documents that share an n-gram is paired off. Each n-gram first links its
documents to the one with the longest reach; components of the verified links are formed;
then only pairs of different components are left, and of those only documents outside the
group's largest component are paired with the others. Within a component no pair can
change the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmill.llm.components import connected_components
from feedmill.llm.tables import give_back, in_steps, text_of
from feedmill.session import cut

SHINGLE_WORDS = 4
THRESHOLD = 85  # hundredths
ORDERS = 3
# An n-gram in at least this share of the sampled documents counts as frequent.
FREQUENT_SHARE = 0.002
SAMPLE_DOCS = 20_000
# N-grams a bin on average, fewest bins, and n-grams of one block on the way to the bins.
BIN_GRAMS = 2_000_000
FEWEST_BINS = 128
BLOCK_GRAMS = 250_000
# Involved texts are found through a broadcast only while their hashes take less than this.
BROADCAST_BYTES = 32 << 20

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_FREQUENT_RANK = np.int64(1) << 40


# --- sets ------------------------------------------------------------------------

class Shingler:
    """Turns texts into sorted arrays of distinct n-gram hashes; knows recent words."""

    def __init__(self, words: int, known: int = 200_000):
        self.words, self.limit = words, known
        self.known: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self.known[word] = value
        return value

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(self.known) > self.limit:
            self.known.clear()
        get = self.known.get
        hashes = np.array([get(w) or self._hash(w) for w in words], dtype=np.uint64)
        size = min(self.words, len(words))
        count = len(hashes) - size + 1
        total = np.full(count, size, dtype=np.uint64)
        for k in range(size):
            total = (total ^ (total >> np.uint64(29))) * _MIX[0] + hashes[k:k + count] * _MIX[1 + k % 4]
        total ^= total >> np.uint64(32)
        total *= _MIX[2]
        total ^= total >> np.uint64(29)
        return np.unique(total)


def _node(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _short(node: bytes) -> int:
    return int.from_bytes(node[:8], "little", signed=True)


_shinglers: dict[int, Shingler] = {}


def shingler(words: int) -> Shingler:
    """One a process and n, so that words stay known from batch to batch."""
    return _shinglers.setdefault(words, Shingler(words))


def task_ends() -> None:
    """Forget the words of this task, so that its worker stays small in later stages."""
    _shinglers.clear()
    give_back()


def describe_sets(texts: DataFrame, words: int) -> DataFrame:
    """``texts`` (with a column text) with n (size of its set), node (16 bytes that name the
    set) and code (its first eight) in place of the text."""
    place = texts.columns.index("text")
    rest = [k for k in range(len(texts.columns)) if k != place]
    names = [texts.columns[k] for k in rest] + ["n", "node", "code"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_text = shingler(words)
        for batch in in_steps(batches):
            sets = [cut_text(t.as_py()) for t in batch.column(place)]
            sizes = [len(s) for s in sets]
            nodes = [_node(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in rest), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array([None if x is None else _short(x) for x in nodes], pa.int64())], names=names)
        task_ends()

    schema = texts.drop("text").schema.add("n", "long").add("node", "binary").add("code", "long")
    return texts.mapInArrow(run, schema)


def frequent_grams(texts: DataFrame, sets: DataFrame, words: int, share: float, sample: int) -> np.ndarray:
    """N-grams in at least ``share`` of about ``sample`` sets, with their rank, sorted.

    Any choice of frequent n-grams gives a right result; it only moves them to the end of
    the orders. At most (mean set size / share) n-grams can qualify, however many documents
    there are, so the list has a bounded size.
    """
    total = sets.count()
    keep = min(1_000_000, 1 + sample * 1_000_000 // max(1, total))
    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < keep).dropDuplicates(["text"])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_text = shingler(words)
        for batch in batches:
            for t in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(cut_text(t.as_py()).view(np.int64))], names=["gram"])
        task_ends()

    least = max(3, int(share * min(sample, total)))
    counts = some.select("text").mapInArrow(grams, "gram long").groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    found = counts.toPandas()
    out = np.zeros(len(found), dtype=[("gram", np.uint64), ("rank", np.int64)])
    out["gram"], out["rank"] = found["gram"].to_numpy().view(np.uint64), found["n"].to_numpy()
    return np.sort(out, order="gram")


# --- orders and prefixes -----------------------------------------------------------

def _reach(n: np.ndarray, place: np.ndarray, threshold: int) -> np.ndarray:
    """Largest set that a set of ``n`` can still be similar to if its first common n-gram
    stands at ``place``: overlap * (100 + t) >= t * (n + m), with n - place left."""
    return ((100 + threshold) * (n - place) - threshold * n) // threshold


def _least(n: np.ndarray, threshold: int) -> np.ndarray:
    """Smallest set that a set of ``n`` can be similar to."""
    return -(-threshold * n // 100)


def shared_grams(texts: DataFrame, words: int, threshold: int, frequent: np.ndarray, bins: int) -> DataFrame:
    """code, n, held (n-grams of the set that are frequent), grams and ranks (packed: the
    n-grams that some other set has too, and how many sets have each), a row a set and bin.

    N-grams travel to their bins packed, four bytes each beside their set's code; a bin
    keeps those that several sets hold. Sets made mostly of frequent n-grams send these
    along, apart from the bins: no n-gram that very many documents share meets in a bin.
    """
    bits = bins.bit_length() - 1

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_text = shingler(words)
        held: list[np.ndarray] = []
        codes: list[int] = []
        seen: set[int] = set()
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, codes, seen, size
            counts = np.array([len(x) for x in held])
            grams, owner = np.concatenate(held), np.repeat(np.array(codes, dtype=np.int64), counts)
            sizes = np.repeat(counts, counts)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent["gram"], grams), len(frequent) - 1)
                often = frequent["gram"][at] == grams
            else:
                at, often = np.zeros(len(grams), dtype=np.int64), np.zeros(len(grams), dtype=bool)
            rows: list[tuple] = []
            # Sets with frequent n-grams: how many, and which, if the prefix can reach them.
            ends = np.cumsum(counts)
            for code, n, low, high in zip(codes, counts.tolist(), (ends - counts).tolist(), ends.tolist(), strict=True):
                own = often[low:high]
                h = int(own.sum())
                need = h > 0 and _reach(n, n - h, threshold) >= _least(n, threshold)
                if h:
                    rows.append((-1 - code % bins, np.array([code]).tobytes(), np.array([n], dtype=np.int32).tobytes(), np.array([h], dtype=np.int32).tobytes(),
                                 grams[low:high][own].tobytes() if need else b"", (frequent["rank"][at[low:high][own]] + _FREQUENT_RANK).tobytes() if need else b""))
            keep = ~often
            grams, owner, sizes = grams[keep], owner[keep], sizes[keep]
            number = (grams >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(number, kind="stable")
            grams, owner, sizes, number = grams[order], owner[order], sizes[order], number[order]
            cuts = np.searchsorted(number, np.arange(bins + 1))
            for b in range(bins):
                low, high = int(cuts[b]), int(cuts[b + 1])
                if low < high:
                    own = owner[low:high]
                    first = np.concatenate([[True], own[1:] != own[:-1]])
                    runs = np.diff(np.append(np.nonzero(first)[0], high - low))
                    rows.append((b, own[first].tobytes(), sizes[low:high][first].astype(np.int32).tobytes(), runs.astype(np.int32).tobytes(),
                                 (grams[low:high] >> np.uint64(32 - bits) & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(), b""))
            held, codes, seen, size = [], [], set(), 0
            for start in range(0, len(rows), 64):
                part = list(zip(*rows[start:start + 64], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[0], pa.int64()), *(pa.array(c, pa.binary()) for c in part[1:])],
                    names=["bin", "codes", "sizes", "runs", "grams", "ranks"])

        for batch in batches:
            for t in batch.column(0):
                own = cut_text(t.as_py())
                if len(own) and (code := _short(_node(own))) not in seen:
                    seen.add(code)
                    codes.append(code)
                    held.append(own)
                    size += len(own)
                    if size >= BLOCK_GRAMS:
                        yield from flush()
        if held:
            yield from flush()
        task_ends()

    def meet(table: pa.Table) -> pa.Table:
        met = meet_in_bin(table)
        give_back()
        return met

    def meet_in_bin(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        number = rows[0]["bin"]
        if number < 0:
            best = {}
            for r in rows:
                best[r["codes"]] = r
            return pa.Table.from_pydict({
                "code": pa.array([np.frombuffer(c, np.int64)[0] for c in best], pa.int64()),
                "n": pa.array([int(np.frombuffer(r["sizes"], np.int32)[0]) for r in best.values()], pa.int64()),
                "held": pa.array([int(np.frombuffer(r["runs"], np.int32)[0]) for r in best.values()], pa.int64()),
                "grams": pa.array([r["grams"] for r in best.values()], pa.binary()),
                "ranks": pa.array([r["ranks"] for r in best.values()], pa.binary())})
        runs = np.concatenate([np.frombuffer(r["runs"], np.int32) for r in rows])
        codes = np.repeat(np.concatenate([np.frombuffer(r["codes"], np.int64) for r in rows]), runs)
        sizes = np.repeat(np.concatenate([np.frombuffer(r["sizes"], np.int32) for r in rows]), runs)
        grams = np.concatenate([np.frombuffer(r["grams"], np.uint32) for r in rows])
        order = np.lexsort((codes, grams))
        grams, codes, sizes = grams[order], codes[order], sizes[order]
        same = (grams[1:] == grams[:-1])
        new = np.concatenate([[True], ~(same & (codes[1:] == codes[:-1]))])
        grams, codes, sizes = grams[new], codes[new], sizes[new]
        first = np.concatenate([[True], grams[1:] != grams[:-1]])
        starts = np.nonzero(first)[0]
        counts = np.diff(np.append(starts, len(grams)))
        ranks = np.repeat(counts, counts)
        several = ranks > 1
        grams, codes, sizes, ranks = grams[several], codes[several], sizes[several], ranks[several].astype(np.int64)
        full = (np.uint64(number) << np.uint64(64 - bits)) | (grams.astype(np.uint64) << np.uint64(32 - bits))
        order = np.argsort(codes, kind="stable")
        full, codes, sizes, ranks = full[order], codes[order], sizes[order], ranks[order]
        starts = np.nonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))[0] if len(codes) else np.empty(0, dtype=np.int64)
        ends = np.append(starts[1:], len(codes)) if len(codes) else starts
        return pa.Table.from_pydict({
            "code": pa.array(codes[starts], pa.int64()), "n": pa.array(sizes[starts].astype(np.int64), pa.int64()),
            "held": pa.array(np.zeros(len(starts), dtype=np.int64)),
            "grams": pa.array([full[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
            "ranks": pa.array([ranks[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())})

    packed = texts.select("text").mapInArrow(
        blocks, "bin long, codes binary, sizes binary, runs binary, grams binary, ranks binary")
    return packed.groupBy("bin").applyInArrow(meet, "code long, n long, held long, grams binary, ranks binary")


def prefixes(shared: DataFrame, orders: int, threshold: int) -> DataFrame:
    """ord, gram, code, n, reach: the n-grams of every set's prefix under each order."""
    sets = shared.groupBy("code", "n").agg(F.sum("held").alias("held"), F.collect_list("grams").alias("grams"), F.collect_list("ranks").alias("ranks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for row in batch.to_pylist():
                grams = np.frombuffer(b"".join(row["grams"]), np.uint64)
                ranks = np.frombuffer(b"".join(row["ranks"]), np.int64)
                n = row["n"]
                often = ranks >= _FREQUENT_RANK
                # Before them stand the n-grams that no other set has.
                alone = n - row["held"] - int((~often).sum())
                for k in range(orders):
                    mixed = grams * _MIX[k]
                    mixed ^= mixed >> np.uint64(31)
                    order = np.lexsort((mixed, ranks))
                    place = alone + np.arange(len(order))
                    reach = _reach(n, place, threshold)
                    keep = reach >= _least(n, threshold)
                    taken = grams[order][keep]
                    out[0].append(np.full(len(taken), k, dtype=np.int32))
                    out[1].append(taken.view(np.int64))
                    out[2].append(np.full(len(taken), row["code"], dtype=np.int64))
                    out[3].append(np.full(len(taken), n, dtype=np.int64))
                    out[4].append(reach[keep].astype(np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["ord", "gram", "code", "n", "reach"])
        give_back()

    return sets.mapInArrow(run, "ord int, gram long, code long, n long, reach long")


# --- candidates and links ------------------------------------------------------------

def _similar_sizes(a: str, b: str) -> Column:
    return (F.col(f"{a}n") <= F.col(f"{b}reach")) & (F.col(f"{b}n") <= F.col(f"{a}reach"))


def in_every_order(pairs: DataFrame, lists: DataFrame, orders: int) -> DataFrame:
    """The pairs (a, b) whose prefixes meet under every order; ``lists`` has code and an
    array of prefix n-grams of each order."""
    sides = {}
    for side in ("a", "b"):
        sides[side] = lists.select(F.col("code").alias(side), *[F.col(f"p{k}").alias(f"{side}{k}") for k in range(orders)])
    met = pairs.join(sides["a"], "a").join(sides["b"], "b")
    condition = F.lit(True)
    for k in range(orders):
        condition = condition & F.arrays_overlap(f"a{k}", f"b{k}")
    return met.where(condition).select("a", "b")


def verified(spark: SparkSession, pairs: DataFrame, texts: DataFrame, classes: DataFrame, words: int, threshold: int) -> DataFrame:
    """The links (a, b: nodes) among candidate pairs of codes, on the whole sets."""
    involved = pairs.select(F.explode(F.array("a", "b")).alias("code")).distinct()
    wanted = cut(classes.join(involved, "code", "left_semi"), "involved")
    hashes = wanted.select(F.col("text_hash").alias("_hash")).distinct()
    if hashes.count() * 16 <= BROADCAST_BYTES:
        hashes = F.broadcast(hashes)
    some = texts.join(hashes, F.xxhash64("text") == F.col("_hash"), "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_text = shingler(words)
        for batch in batches:
            seen: set[bytes] = set()
            for t in batch.column(0):
                own = cut_text(t.as_py())
                if len(own) and (node := _node(own)) not in seen:
                    seen.add(node)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([node], pa.binary()), pa.array([_short(node)], pa.int64()), pa.array([own.tobytes()], pa.binary())],
                        names=["node", "code", "grams"])
        task_ends()

    held = cut(some.mapInArrow(sets, "node binary, code long, grams binary").dropDuplicates(["node"]), "sets")
    right = held.select(F.col("code").alias("b"), F.col("node").alias("node_b"), F.col("grams").alias("grams_b"))
    left = held.select(F.col("code").alias("a"), F.col("node").alias("node_a"), F.col("grams").alias("grams_a"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])
        give_back()

    both = pairs.join(right, "b").join(left, "a").where("node_a <> node_b")
    return both.select("node_a", "node_b", "grams_a", "grams_b").mapInArrow(check, "a binary, b binary")


def jaccard_classes(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
    threshold: int = THRESHOLD, orders: int = ORDERS, carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row a row of ``docs``: doc_id, n_shingles, component_id, component (the group's
    own name, null for an empty set), and the ``carry`` columns.

    Letters A-Z are lower-cased; words are runs of anything but ASCII white space. A text
    with fewer than ``words`` words is one n-gram of them all. Two documents link when
    100 * intersection >= threshold * union; component_id is the smallest id reachable.
    A null or empty text, or one without words, has an empty set and is its own component.
    Repeated rows are linked by their equal sets; rows with a null id take part, and their
    component's id is the smallest known one, null if there is none. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(text_of(text_col).alias("text"))
    sets = cut(describe_sets(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
        *[F.col(c).alias(f"_carry_{c}") for c in carry], text_of(text_col).alias("text")), words), "sets")
    classes = cut(sets.where("node IS NOT NULL").groupBy("node", "code").agg(
        F.min("doc_id").alias("first_id"), F.min("text_hash").alias("text_hash"), F.first("n").alias("n")), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    bins = max(FEWEST_BINS, 1 << max(0, int(total // BIN_GRAMS)).bit_length())
    if bins > 1 << 24:
        bins = 1 << 24
    frequent = frequent_grams(texts, sets, words, FREQUENT_SHARE, SAMPLE_DOCS)
    entries = prefixes(shared_grams(texts, words, threshold, frequent, bins), orders, threshold)
    entries = cut(entries, "prefixes")
    # An entry is of use only where a set that it can reach shares its n-gram.
    smallest = entries.groupBy("ord", "gram").agg(F.min("n").alias("low"), F.max("reach").alias("far"), F.count("*").alias("sets"))
    entries = cut(entries.join(smallest.where("sets > 1"), ["ord", "gram"]).where("low <= reach AND n <= far")
                  .select("ord", "gram", "code", "n", "reach"), "entries")
    lists = entries.groupBy("code").agg(*[
        F.collect_list(F.when(F.col("ord") == k, F.col("gram"))).alias(f"p{k}") for k in range(orders)])
    lists = cut(lists, "lists")

    hub = entries.groupBy("ord", "gram").agg(F.max(F.struct("reach", "code", "n")).alias("hub")).select(
        "ord", "gram", F.col("hub.code").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.reach").alias("hub_reach"))
    near = entries.join(hub, ["ord", "gram"]).where(
        (F.col("code") != F.col("hub")) & (F.col("n") <= F.col("hub_reach")) & (F.col("hub_n") <= F.col("reach")))
    stars = near.select(F.least("code", "hub").alias("a"), F.greatest("code", "hub").alias("b")).distinct()
    # Sets whose codes agree by chance are candidates too.
    double = classes.groupBy("code").agg(F.count("*").alias("sets")).where("sets > 1").select(F.col("code").alias("a"), F.col("code").alias("b"))
    first = cut(in_every_order(stars, lists, orders).unionByName(double), "stars")
    links = cut(verified(spark, first, texts, classes, words, threshold), "links")
    groups = cut(connected_components(links), "components")

    # Members of each n-gram's group by component; the largest component pairs with no one of its own.
    codes = classes.join(groups, "node", "left").select("code", F.coalesce("component", "node").alias("component"))
    members = cut(entries.where("ord = 0").join(codes, "code"), "members")
    counts = members.groupBy("gram", "component").agg(F.count("*").alias("size"))
    main = counts.groupBy("gram").agg(F.max(F.struct("size", "component")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    main = main.select("gram", F.col("main.component").alias("main"))
    mixed = cut(members.join(main, "gram"), "mixed")
    minor = mixed.where("component <> main").select("gram", *[F.col(c).alias(f"minor_{c}") for c in ("code", "n", "reach", "component")])
    across = minor.join(mixed, "gram").where(
        (F.col("component") != F.col("minor_component")) & _similar_sizes("", "minor_")
        & ((F.col("component") == F.col("main")) | (F.col("code") > F.col("minor_code"))))
    pairs = across.select(F.least("code", "minor_code").alias("a"), F.greatest("code", "minor_code").alias("b")).where("a <> b").distinct()
    second = cut(in_every_order(pairs, lists, orders), "across")
    more = verified(spark, second, texts, classes, words, threshold)
    groups = cut(connected_components(links.unionByName(more)), "components")

    owner = classes.join(groups, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "first_id")
    least = owner.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = owner.join(least, "component").select("node", "component", "component_id")
    return sets.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component", *[F.col(f"_carry_{c}").alias(c) for c in carry])
