"""Archives (op6), the Jaccard join (op8), nearest neighbours (op10) and the pipeline."""

import collections
import gzip
import io
import random
import re
import zipfile

import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from checks import differences, open_tables
from feedmill.llm import web_archive as wa
from feedmill.llm.components import connected_components
from feedmill.llm.jaccard_join import jaccard_classes
from feedmill.llm.nearest import chi_square, chi_square_point, nearest_neighbours
from feedmill.llm.queries import QUERIES, SQL
from feedmill.session import new_folder

from llm_rows import FOLDER, ROWS, prose


# ---- archives -------------------------------------------------------------------

@pytest.mark.parametrize("zip64", [False, True])
def test_packages_are_zip_files_read_by_range(tmp_path, zip64):
    record = wa.record_bytes("response", 7, "7", "http://x/", "d", 5, b"hello", None)
    content = wa.pack([(wa.DATA, b"junk" + record), (wa.INDEX, b'x 2024 {"offset": 4, "length": %d, "filename": "%s"}\n' % (len(record), wa.DATA.encode()))], zip64)
    with zipfile.ZipFile(io.BytesIO(content)) as package:
        assert package.testzip() is None and package.namelist() == [wa.DATA, wa.INDEX]
        assert gzip.decompress(package.read(wa.DATA)[4:]).startswith(b"WARC/1.1")
    path = tmp_path / "p.wacz"
    path.write_bytes(content)
    for source in (wa.BytesRange(content), wa.FileRange(str(path))):
        package = wa.Package(source)
        line = next(package.index())
        headers, payload = package.record(line["offset"], line["length"], line["filename"])
        assert payload == b"hello" and headers["X-Page"] == "7" and headers["WARC-Type"] == "response"
    with pytest.raises(ValueError, match="central directory"):
        wa.Package(wa.BytesRange(content[:-30]))


def test_packages_of_other_writers():
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as package:
        package.writestr(wa.INDEX, "x 2024 {}\n")
        package.writestr(zipfile.ZipInfo("z"), b"abc" * 100, compress_type=zipfile.ZIP_DEFLATED)
        package.comment = b"PK\x05\x06 in a comment"
    package = wa.Package(wa.BytesRange(data.getvalue()))
    assert list(package.index()) == [{}]
    with pytest.raises(ValueError, match="compressed"):
        package.data_start(package.members["z"])


def test_op6_query(spark):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    assert differences(QUERIES["op6_web_archive"](spark, folder), open_tables(folder), SQL["op6_web_archive"]) == ""


def test_archive_of_odd_pages(spark):
    big = "é" * 600
    rows = [(1, "u", big), (3, "u", big), (3, "u", big), (None, None, big), (4, "a b\nc", ""), (5, "u", None), (6, "u", "short"), (7, "u", "short"),
            (8, "u", "y" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url as digest", "url as payload", "url as last")
    path = new_folder(spark, "pages")
    wa.write_packages(df, path)
    got = collections.Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in wa.read_packages(spark, path).collect())
    assert got == collections.Counter([
        (1, 1200, "revisit", 3), (3, 1200, "response", None), (3, 1200, "response", None), (None, 1200, "revisit", 3), (4, 0, "response", None),
        (5, 0, "response", None), (6, 5, "response", None), (7, 5, "response", None), (8, 3_000_000, "response", None)])
    path = new_folder(spark, "none")
    wa.write_packages(df.limit(0), path)
    assert wa.read_packages(spark, path).collect() == []


# ---- Jaccard join ---------------------------------------------------------------

def brute_classes(rows, words=4, threshold=85):
    """doc_id, n_shingles, component id of every row, by comparing all sets."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        n = min(words, len(w))
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    holders = collections.defaultdict(list)
    for k, s in enumerate(sets):
        near = {j for g in s for j in holders[g]}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= threshold * (len(s) + len(sets[j]) - both):
                root[find(k)] = find(j)
        for g in s:
            holders[g].append(k)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    return [(doc, len(sets[k]), least.get(find(k)) if sets[k] else doc) for k, (doc, _) in enumerate(rows)]


def same(found, rows, **options):
    order = lambda r: tuple((v is not None, v) for v in r)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found], key=order) == sorted(brute_classes(rows, **options), key=order)


def test_op8_query(spark):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    same(QUERIES["op8_jaccard_join"](spark, folder).collect(), rows)


def test_join_of_odd_rows(odd, nothing):
    same(jaccard_classes(odd).collect(), [(r[0], r[1]) for r in ROWS])
    assert jaccard_classes(nothing).collect() == []


def test_join_of_many_near_copies(spark):
    """A big group of copies with few and many edits, texts around one passage, and copies
    of other lengths: links at, above and below the threshold, and chains of them."""
    rnd = random.Random(4)
    base, passage = prose(7, 150).split(), prose(8, 60)
    rows = []
    for k in range(260):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            words[rnd.randrange(150)] = f"w{rnd.randrange(3000)}"
        cut = rnd.choice([0, 0, 0, 5, 12, 20])
        rows.append((1000 - k, " ".join(words[cut:])))
    rows += [(2000 + k, prose(50 + k, rnd.choice([10, 30, 200])) + " " + passage) for k in range(60)]
    rows += [(3000 + k, " ".join(base[:k])) for k in range(3, 40, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    same(jaccard_classes(df).collect(), rows)
    same(jaccard_classes(df, words=5, threshold=80).collect(), rows, words=5, threshold=80)


def test_components(spark):
    rnd = random.Random(2)
    links = [(k, k + 1) for k in range(0, 300) if k % 50] + [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(250)] + [(2000, k) for k in range(2001, 2300)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


# ---- nearest neighbours ---------------------------------------------------------

def brute_nearest(ids, vectors, query, k=10):
    own = np.array(vectors[query], dtype=float)
    far = [(float(np.sqrt(((np.array(v, dtype=float) - own) ** 2).sum())), i) for j, (i, v) in enumerate(zip(ids, vectors)) if i != ids[query]]
    return sorted(far)[:k]


def test_op10_query(spark):
    folder = FOLDER.replace("sf0.001", "sf0.1")
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, vectors = [r.vec_id for r in rows], [r.embedding for r in rows]
    found = collections.defaultdict(dict)
    for r in QUERIES["op10_nearest_neighbours"](spark, folder).collect():
        found[r.query_id][r.rank] = (r.score, r.vec_id)
    hits = total = 0
    for q, i in enumerate(ids):
        if i % 100 == 0:
            want, got = brute_nearest(ids, vectors, q), [found[i][k] for k in range(1, 11)]
            assert got == sorted(got)
            hits += len({x[1] for x in want} & {x[1] for x in got})
            total += 10
            for score, vec in got:
                assert abs(score - np.linalg.norm(np.array(vectors[ids.index(vec)], float) - np.array(vectors[q], float))) < 1e-12
    assert hits / total >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (200, None), (300, [0.0, 0.0]), (400, [nan, 1.0]), (500, [inf, 1.0]), (600, [1.0, None]),
            (700, [1.0, 2.0, 3.0]), (800, [1.0, 2.0, 4.0]), (None, [1.0, 0.1])] + [(k, [1.0, 0.0]) for k in range(1, 40)] + [(41, [2.0, 0.0]), (900, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "vec_id as size", "vec_id as cell", "vec_id as v")
    got = collections.defaultdict(list)
    for r in sorted(nearest_neighbours(df, F.col("id") % 100 == 0, cell=8).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.score, r.vec_id))
    assert set(got) == {0, 100, 700, 800, 900}
    assert got[0] == [(0.0, k) for k in range(1, 11)] and got[100] == [(0.0, k) for k in range(0, 10)]
    assert got[700] == [(1.0, 800)] and got[800] == [(1.0, 700)]
    assert got[900] == [(0.0, 41)] + [(1.0, k) for k in range(0, 9)]
    assert nearest_neighbours(df.limit(0), F.col("id") % 100 == 0).collect() == []


def test_chi_square():
    assert chi_square(0.0, 12) == 0 and abs(chi_square(11.340322, 12) - 0.5) < 1e-6
    assert abs(chi_square_point(0.95, 12) - 21.026070) < 1e-5


# ---- pipeline -------------------------------------------------------------------

def test_pipeline_stages(spark, documents):
    docs = documents
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, FOLDER), name)
        kept[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == documents.columns
    all_rows = {r.doc_id: r for r in documents.collect()}
    assert {r.doc_id for r in kept["language"]} == {k for k, r in all_rows.items() if any(c.isalpha() for c in r.text or "")}
    classes = brute_classes([(r.doc_id, r.text) for r in kept["language"]], 5, 80)
    assert sorted(r.doc_id for r in kept["near_duplicates"]) == sorted({c[2] for c in classes})
    assert sorted(r.doc_id for r in kept["personal_data"]) == sorted(r.doc_id for r in kept["near_duplicates"])
    assert not [r for r in kept["personal_data"] if re.search(r"[a-z0-9]@[a-z0-9]+\.[a-z]", r.text)]
    assert all(r.n_chars == len(r.text) for r in kept["personal_data"])
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in kept["personal_data"]}
    taken = collections.Counter(r.doc_id for r in kept["mix"])
    assert max(taken.values()) <= 2
    assert abs(sum(sizes[d] * n for d, n in taken.items()) - 1.5 * sum(sizes.values())) < 0.1 * sum(sizes.values())
    assert collections.Counter(r.doc_id for r in kept["tokens"]) == taken
    assert all(len(r.ids) == r.n_tokens for r in kept["tokens"])


def test_stages_bear_odd_rows(spark, odd, nothing):
    for df in (odd.withColumn("n_chars", odd["doc_id"]), nothing.withColumn("n_chars", nothing["doc_id"])):
        docs = df
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.cut(stage(spark, docs, FOLDER), name)
            assert name == "tokens" or docs.columns == df.columns
