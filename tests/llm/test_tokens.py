"""Token files (op1) and byte-level BPE (op3) against the tokenizers library."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from feedmill.llm import token_files
from feedmill.llm.bpe import codec, encode_decode
from feedmill.llm.pieces import is_closed
from feedmill.llm.queries import QUERIES
from feedmill.llm.token_files import Shard, library_encoder, pack_shard, read_token_files, write_token_files
from feedmill.session import new_folder

from llm_rows import FOLDER, ROWS, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def expected_files(library, rows, end_id=2):
    out, start = [], 0
    pairs = [(r[0], r[1] or "", ids + [end_id]) for r, ids in zip(rows, ids_of(library, [r[1] for r in rows]))]
    for doc, _, ids in sorted(pairs, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode())):
        out.append((doc, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r))


def test_encoders_agree_with_the_library(library):
    alphabet = " \n\t.,'!ab cde éß<|>0129  日🙂\x1c\x85᠎​"
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["a  b", " a", "a ", "\n\n a\n", "x<|endoftext|>y", "don't we'll", "A" * 300, "!?" * 200, "ab" * 5000]
    want = ids_of(library, texts)
    encoder = library_encoder(PATH)
    for some in (texts, texts[::-1]):
        ids, counts = encoder.encode(pa.array(some))
        found = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert found == (want if some is texts else want[::-1])
    assert [x.tolist() for x in codec(PATH).encode(texts)] == want
    for ids in want + [[rnd.randrange(50257) for _ in range(30)] for _ in range(100)]:
        assert codec(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("top", [200, 256, 70_000, 2**31])
def test_codes_give_any_token(top):
    ids = np.random.default_rng(top).integers(0, top, 3000).astype(np.uint32)
    shard = Shard(pack_shard([5, None], np.array([1000, 2000]), ids))
    assert [shard.token(k) for k in range(0, 3000, 37)] == ids[::37].tolist()
    assert [(d, s, x.tolist()) for d, s, x in shard.documents()] == [(5, 0, ids[:1000].tolist()), (None, 1000, ids[1000:].tolist())]
    assert shard.slice(777, 2001).tolist() == ids[777:2001].tolist()
    with pytest.raises(IndexError):
        shard.token(3000)


def test_token_files_of_odd_rows(spark, odd, nothing, library):
    for df, rows in ((odd, ROWS), (nothing, [])):
        path = new_folder(spark, "tokens")
        write_token_files(df, path, PATH, 2)
        found = read_token_files(spark, path)
        assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        assert order(found.collect()) == order(expected_files(library, rows))


def test_equal_ids_keep_their_order(spark, library):
    """Any number of tasks gives every row the same start."""
    rows = [(k % 3 if k % 4 else None, f"{prose(k, 30)} {k % 50}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for tasks in ("2", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        path = new_folder(spark, "tokens")
        write_token_files(df, path, PATH, 2)
        found.append(order(read_token_files(spark, path).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == order(expected_files(library, rows))


def test_op1_query(spark, documents, library):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert order(QUERIES["op1_token_files"](spark, FOLDER).collect()) == order(expected_files(library, rows))


def expected_bpe(library, rows):
    return [(r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())
            for r, ids in zip(rows, ids_of(library, [r[1] for r in rows]))]


def test_bpe_of_odd_rows(odd, nothing, library):
    assert order(encode_decode(odd, PATH).collect()) == order(expected_bpe(library, ROWS))
    assert encode_decode(nothing, PATH, with_ids=True).collect() == []
    with_ids = encode_decode(odd.where("doc_id = 8"), PATH, with_ids=True).first()
    assert with_ids.ids == ids_of(library, ["one two"])[0]


def test_op3_query(spark, documents, library):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert order(QUERIES["op3_bpe"](spark, FOLDER).collect()) == order(expected_bpe(library, rows))


def test_parts_are_judged_once_a_last_character(monkeypatch):
    """Whether a part is closed follows from its last character; 3,000 new parts have four here."""
    asked = []
    monkeypatch.setattr(token_files, "is_closed", lambda part: asked.append(part) or is_closed(part))
    encoder = token_files.PartIds(PATH)
    texts = [" ".join(f"w{k}x{j}{'ab.é'[j % 4]}" for j in range(300)) for k in range(10)] + ["", " ", "a  b", "one\n two ", "日本 語"]
    ids, counts = encoder.encode(pa.array(texts))
    assert 0 < len(asked) <= 12
    want = [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert counts.tolist() == [len(own) for own in want] and ids.tolist() == [x for own in want for x in own]
