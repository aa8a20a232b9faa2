"""Cross-tokenizer alignment (op13) against whole texts and plain loops."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from feedmill.llm.alignment import align_documents, byte_ends, byte_level_alphabet
from feedmill.llm.queries import QUERIES

from llm_rows import FOLDER, ROWS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def groups_of():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = byte_level_alphabet()

    def find(text):
        raw = (" " + (text or "")).encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_bytes = [bytes(alphabet[c] for c in first.id_to_token(k)) for k in a]
        b_bytes = [bytes([int(second.id_to_piece(k)[3:5], 16)]) if second.is_byte(k) else second.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return []
        out, i, j, at_a, at_b = [], 0, 0, 0, 0
        own = ([], [])
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                own[0].append(a[i])
                at_a, i = at_a + len(a_bytes[i]), i + 1
            else:
                own[1].append(b[j])
                at_b, j = at_b + len(b_bytes[j]), j + 1
            if at_a == at_b:
                out.append(own)
                own = ([], [])
        return out

    return find


def expected(rows, groups_of):
    """Plain loops over all links."""
    all_groups = [(doc, groups_of(text)) for doc, text in rows]
    links = [collections.Counter((a, b) for x, y in g for a in x for b in y) for _, g in all_groups]
    counts = collections.Counter(pair for own in links for pair in own)
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (doc, g), own in zip(all_groups, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((doc, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()),
                    sum(k for (a, b), k in own.items() if counts[a, b] == best[a]), sum(k * counts[p] for p, k in own.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_spans_are_refined_by_decoded_bytes():
    # Two tokens share the character at 2-5, three stand for single bytes of the one at 6-9.
    starts, ends = np.array([0, 2, 2, 5, 6, 6, 6]), np.array([2, 5, 5, 6, 6, 6, 9])
    assert byte_ends(starts, ends, np.array([2, 1, 2, 1, 1, 1, 1])).tolist() == [2, 3, 5, 6, 7, 8, 9]
    assert byte_ends(np.empty(0, int), np.empty(0, int), np.empty(0, int)).tolist() == []


@pytest.mark.parametrize("broadcast", [1 << 21, 40])
def test_alignment_of_odd_texts(spark, groups_of, broadcast):
    rnd = random.Random(3)
    alphabet = " \n\t.,'!ab cde éß<|>0129  日🙂\x1c\x85᠎​\x00𐍈ก"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    texts += ["a ▁ b", "▁", " ", "  ", "a ", " a", "a \n b", "a  b", "<|endoftext|> <s> <0x41>", "\n\n x", "日本語 🙂🙂", "don't we'll", "word " * 50,
              "=" * 700, "x" * 3000, "a　 b c", "٣ ४", "é" * 400]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, None), (None, "a b"), (5, "a b"), (5, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(align_documents(df, A, B, broadcast=broadcast)) == expected(rows, groups_of)


def test_alignment_of_odd_rows(odd, nothing, groups_of):
    assert found(align_documents(odd, A, B)) == expected([r[:2] for r in ROWS], groups_of)
    assert found(align_documents(nothing, A, B)) == []
    one = align_documents(odd.where("doc_id = 8"), A, B, with_groups=True).first()
    assert hashlib.sha256(one.groups.encode()).hexdigest() == one.groups_sha256


def test_op13_query(spark, documents, groups_of):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(QUERIES["op13_token_alignment"](spark, FOLDER)) == expected(rows, groups_of)
