"""Licences (op2), personal data (op4), quality rules (op5), languages (op7), mixing (op9)."""

import collections
import hashlib
import math
import re
import struct
import zlib

import pytest
from pyspark.sql import functions as F
import xxhash

from checks import differences, open_tables
from feedmill.llm import licences, mixing, personal_data, quality
from feedmill.llm.language_id import predict_language, train_network
from feedmill.llm.queries import QUERIES, SQL

from llm_rows import FOLDER, ROWS, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ["email", "ip", "card", "phone"]


def key(row):
    return tuple((v is not None, v) for v in row)


# ---- personal data --------------------------------------------------------------

def base_spans(text):
    def check(digits):
        total = 0
        for k, d in enumerate(map(int, digits[::-1])):
            total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
        return total % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and check(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def joined(spans):
    return ",".join("%s:%d:%d" % s for s in spans)


def check_personal(rows, found):
    want = []
    for doc, text in rows:
        spans = base_spans(text or "")
        want.append((doc, *[sum(s[0] == k for s in spans) for k in KINDS], hashlib.sha256(joined(spans).encode()).hexdigest()))
    assert sorted([tuple(r)[:6] for r in found], key=key) == sorted(want, key=key)


def test_personal_data_of_odd_rows(odd, nothing):
    found = personal_data.digest(personal_data.detect(odd.select("doc_id", "text"))).collect()
    check_personal([(r[0], r[1]) for r in ROWS], found)
    assert personal_data.detect(nothing).collect() == []
    masked = personal_data.mask(odd)
    assert masked.columns == odd.columns and masked.count() == len(ROWS)
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[12] == "write to <EMAIL> or <PHONE> or <IP>" and texts[3] is None and texts[4] == ""
    assert personal_data.mask(nothing).collect() == []


def test_hostile_texts_are_quick():
    for text in ("1" * 200_000, "1 " * 100_000, "a@" * 50_000, "1.2." * 50_000, "+1 " * 50_000, "0" * 200_000 + ".0.0.1", "token=" * 30_000):
        personal_data.candidate_spans(text, personal_data.base_spans(text))


def test_op4_query(spark, documents):
    rows = QUERIES["op4_personal_data"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    check_personal(list(texts.items()), rows)
    for row in rows:
        assert set(filter(None, joined(base_spans(texts[row.doc_id])).split(","))) <= set(row.spans.split(","))
        # The method adds the keys that follow a name, and no clean text's words.
        added = [s for s in row.spans.split(",") if s and s.split(":")[0] not in KINDS]
        keys = [m.span(1) for m in re.finditer(r'token = "([0-9a-f]{40})"', texts[row.doc_id])]
        assert {("secret", *k) for k in keys} == {(k, int(a), int(b)) for k, a, b in (s.split(":") for s in added)}


def with_documents(spark, documents, *texts):
    """The texts, under negative ids, masked among the documents they are judged with."""
    extra = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    masked = personal_data.mask(documents.select("doc_id", "text").unionByName(extra)).where("doc_id < 0")
    return [r.text for r in masked.orderBy("doc_id", ascending=False).collect()]


def test_keys_and_addresses_in_any_case(spark, documents):
    value = "9233A8ECF7C5D1B04E6F9233A8ECF7C5D1B04E6F"
    found = with_documents(spark, documents, f'TOKEN = "{value}"', f'Api_Key = "{value}"', f'token = "{value.lower()}" and Token = "{value}"')
    assert found == ['TOKEN = "<SECRET>"', 'Api_Key = "<SECRET>"', 'token = "<SECRET>" and Token = "<SECRET>"']
    for text in ("jane.doe AT example DOT com", "jane.doe(AT)example(DOT)com", "jane.doe [at] example [dot] com"):
        assert personal_data.candidate_spans(text, []) == [("email_words", 0, len(text))]


def test_keys_go_to_their_end(spark):
    # The smallest table has no key, so nothing to learn keys from.
    documents = spark.read.parquet(FOLDER.replace("sf0.001", "sf0.01") + "/documents.parquet")
    jwt = "eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9.eyJzdWIiOiIxMjM0NTY3ODkwIiwibmFtZSI6IkpvaG4ifQ.SflKxwRJSMeKKF2QT4fwpMeJf36POk6yJV_adQssw5c"
    long = "".join(hashlib.sha256(str(k).encode()).hexdigest() for k in range(5))[:298] + "=="
    uuid = "12345678-9abc-4def-8123-456789abcdef"
    found = with_documents(spark, documents, f"token: {jwt}.", f'secret = "{long}"', f"token = {uuid} ends")
    assert found == ["token: <SECRET>.", 'secret = "<SECRET>"', "token = <SECRET> ends"]
    for text in ("token=" + "." * 200_000, "token=a" + ".a" * 100_000, "key:" * 50_000):
        personal_data.candidate_spans(text, [])


def test_added_spans_are_counted_and_clashing_columns_replaced(spark, documents):
    rows = [(10**6 + k, f"mail me: jane{k}.doe (at) example (dot) com or token = {hashlib.sha256(str(k).encode()).hexdigest()}") for k in range(30)]
    rows.append((10**6 + 99, "an order number of " + "1234567 " * 9))
    both = documents.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    for name in ("base", "added", "candidates", "spans", "votes"):
        both = both.withColumn(name, F.lit("x"))
    found = personal_data.detect(both)
    assert found.columns == ["doc_id", "spans", "votes", "base", "added"]
    digest = personal_data.digest(found)
    assert digest.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "n_email_words", "n_number", "n_secret"]
    for r in digest.collect():
        kinds = collections.Counter(span.split(":")[0] for span in r.spans.split(",") if span)
        assert [r[f"n_{k}"] for k in ("email_words", "number", "secret")] == [kinds[k] for k in ("email_words", "number", "secret")]
        assert r.n_added == r.n_email_words + r.n_number + r.n_secret
        assert not 10**6 <= r.doc_id < 10**6 + 30 or r.n_secret == 1
    # A number of any length is one candidate.
    text = "order " + "1234567 " * 9 + "x"
    assert personal_data.candidate_spans(text, []) == [("number", 6, 6 + 71)]


def test_em_finds_the_bad_labeler():
    # Labelers 0, 1 and 2 agree with the truth, labeler 3 votes at random.
    patterns = {}
    for truth, count in ((0, 800), (2, 200)):
        for noise in (0, 2):
            patterns[((truth * 3 + truth) * 3 + truth) * 3 + noise] = count // 2
    likely, table = personal_data.estimate_reliabilities(patterns)
    assert all((p > 0.95) == (k // 27 == 2) for k, p in likely.items())
    assert table[1, 0, 2] > 0.9 and abs(table[1, 3, 2] - table[1, 3, 0]) < 0.1


# ---- quality --------------------------------------------------------------------

def base_counts(text):
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    seen = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) for j in range(3) if seen[tuple(words[k:k + 3])] > 1}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def buckets(text, size):
    def spark_hash(*words):
        seed = 42
        for w in words:
            seed = xxhash.xxh64_intdigest(w.encode(), seed=seed)
        return seed - 2**64 if seed >= 2**63 else seed

    def of_hashes(*hashes):
        seed = 42
        for h in hashes:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", h), seed=seed)
        return (seed - 2**64 if seed >= 2**63 else seed) % size

    words = WORD.findall(text)
    hashes = [spark_hash(w) for w in words]
    return [h % size for h in hashes] + [of_hashes(*p) for p in zip(hashes, hashes[1:])]


def check_quality(rows, trusted, found, size=quality.BUCKETS):
    raw, good = collections.Counter(), collections.Counter()
    for doc, text in rows:
        own = buckets(text or "", size)
        raw.update(own)
        if doc in trusted:
            good.update(own)
    total, share = raw.total(), quality.MIXED
    ratio = {b: round(1000 * math.log((good[b] / raw[b] * total + share * good.total()) / ((1 + share) * good.total()))) for b in raw}
    want = []
    for doc, text in rows:
        counts, own = base_counts(text or ""), buckets(text or "", size)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        score = sum(ratio[b] for b in own) / len(own) if own else None
        want.append((doc, *counts, failed, not failed and score >= quality.THRESHOLD, score))
    got = sorted((tuple(r) for r in found), key=lambda r: key(r[:7]))
    for a, b in zip(got, sorted(want, key=lambda r: key(r[:7])), strict=True):
        assert a[:8] == b[:8]
        assert a[8] == b[8] or abs(a[8] - b[8]) < 1


def test_quality_ngrams_need_no_sequence(spark):
    """Word pairs come of two arrays side by side; buckets are taken of rows, not inside arrays."""
    texts = spark.createDataFrame([("",), ("a",), ("a b",), ("a b a b",)], "text string").withColumn("trusted", F.lit(1))
    counts = quality.bucket_counts(texts, 1 << 21)
    assert sorted((r.raw, r.good) for r in counts.collect()) == [(1, 1), (3, 3), (3, 3), (4, 4)]
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and "lambda pmod" not in plan and "lambdafunction(cast(pmod" not in plan


def test_quality_of_odd_rows(spark, odd, nothing):
    trusted = spark.createDataFrame([(6,), (1,), (None,), (6,)], "doc_id long")
    check_quality([(r[0], r[1]) for r in ROWS], {6, 1}, quality.apply_rules(odd, trusted).collect())
    assert quality.apply_rules(nothing, trusted).collect() == []
    assert not [r for r in quality.apply_rules(odd, trusted.limit(0)).collect() if r.base_failed == r.kept and r.n_words >= 50]


def test_op5_query(spark, documents):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    found = QUERIES["op5_quality_rules"](spark, FOLDER)
    check_quality([(r.doc_id, r.text) for r in documents.collect()], {k for k, q in labels.items() if q == 1}, found.collect())
    kept = {r.doc_id: r.kept for r in found.collect() if not r.base_failed}
    good = [kept[k] for k, q in labels.items() if q == 1 and k in kept]
    assert sum(good) == len(good)
    plan = found._jdf.queryExecution().toString()
    assert not re.search("Python|InPandas|InArrow|Cartesian|NestedLoop", plan)


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_bad_texts_are_dropped_at_every_size(spark, scale):
    folder = FOLDER.replace("sf0.001", scale)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [r for r in QUERIES["op5_quality_rules"](spark, folder).select("doc_id", "base_failed", "kept").collect() if not r.base_failed]
    bad, good = ([r.kept for r in judged if labels.get(r.doc_id) == q] for q in (0, 1))
    assert sum(bad) <= 0.1 * len(bad) and sum(good) == len(good)


def test_trusted_ids_by_shuffle_and_other_buckets(spark, odd, nothing, monkeypatch):
    trusted = spark.createDataFrame([(6,), (1,)], "doc_id long")
    monkeypatch.setattr(quality, "BROADCAST_BYTES", 0)
    for buckets in (quality.PACKED, 5000):
        size = -(-buckets // quality.PACKED) * quality.PACKED
        check_quality([(r[0], r[1]) for r in ROWS], {6, 1}, quality.apply_rules(odd, trusted, buckets=buckets).collect(), size)
    assert quality.apply_rules(nothing, trusted, buckets=100).collect() == []


# ---- languages ------------------------------------------------------------------

def test_op7_query(spark):
    # The smallest table has too few texts to learn from.
    folder = FOLDER.replace("sf0.001", "sf0.01")
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op7_language_id"](spark, folder).collect()
    assert len(found) == len(docs)
    right = total = 0
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out and docs[r.doc_id].lang:
            total += 1
            right += r.lang_pred == docs[r.doc_id].lang
    assert right / total > 0.97


def test_language_of_odd_rows(spark, odd, nothing):
    network = train_network(odd, "text", "lang", key=odd["doc_id"], sample_texts=5)
    assert network.labels == ["de", "en"]
    found = predict_language(odd, network)
    assert found.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    for r in found.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert train_network(nothing, "text", "lang", key=nothing["doc_id"]) is None
    assert {r.lang_pred for r in predict_language(odd, None).collect()} == {"und"}
    assert predict_language(nothing, network).collect() == []


def test_texts_without_ids_are_learnt_from(spark):
    rows = [(None, prose(k, 12), "en") for k in range(2500)] + [(7, f"{prose(k, 12)} żółć ęą".upper(), "pl") for k in range(2500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = train_network(df, "text", "lang", key=df["doc_id"], sample_texts=100)
    assert network is not None and network.labels == ["en", "pl"]
    found = predict_language(df, network).collect()
    assert sum(r.lang_pred == r.lang for r in found) > 0.97 * len(found)
    # Copies of one text share a hash whatever it is made of; a sample may be empty.
    copies = [spark.range(2500).selectExpr("null as doc_id", f"'text {k}' as text", "'en' as lang") for k in range(8)]
    for same in copies:
        network = train_network(same, "text", "lang", key=same["doc_id"].cast("long"), sample_texts=1)
        assert network is None or network.labels == ["en"]


# ---- licences -------------------------------------------------------------------

def test_op2_query(spark):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    stated = {"General Public": "GPL", "All rights reserved": "Proprietary", "MIT License": "MIT", "Apache License": "Apache-2.0", "CC BY-NC": "CC-BY-NC"}
    for r in QUERIES["op2_licences"](spark, folder).collect():
        want = sorted({name for words, name in stated.items() if words in texts[r.doc_id]})
        assert r.families == ",".join(want)


def test_licences_of_odd_rows(spark, odd, nothing):
    model = licences.train_model(odd)
    assert licences.scan_licences(odd, model).count() == len(ROWS)
    assert not [r for r in licences.scan_licences(odd, model).collect() if r.families]
    assert licences.scan_licences(nothing, licences.train_model(nothing)).collect() == []
    text = prose(3, 60) + "\n" + prose(4, 40) + " Released under the MIT License. " + prose(5, 40) + "\nlicensed to nobody, rights of the mozilla\n"
    found = model.scan(text)
    assert [f[0] for f in found] == ["MIT"] and text[found[0][1]:found[0][2]].count("MIT License") == 1
    assert model.scan(prose(8, 200)) == []


@pytest.fixture(scope="module")
def licence_model(spark):
    return licences.train_model(spark.read.parquet(FOLDER.replace("sf0.001", "sf0.01") + "/documents.parquet"))


HEADERS = {
    "GPL": "This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
           "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.",
    "LGPL": "This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n"
            " * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
}


@pytest.mark.parametrize("family", HEADERS)
def test_wrapped_headers(licence_model, family):
    text = prose(3, 60) + "\n\n" + HEADERS[family] + "\n\n" + prose(4, 60)
    found = licence_model.scan(text)
    assert {f[0] for f in found} == {family}
    assert text.index(HEADERS[family]) <= found[0][1] < found[0][2] <= text.index(HEADERS[family]) + len(HEADERS[family])


def test_a_paragraph_may_state_several_licences(licence_model):
    for gap in (" ", " or ", " " + prose(7, 300) + " "):
        text = prose(5, 2000) + " Licensed under the Apache License, Version 2.0." + gap + "Released under the MIT License. " + prose(6, 2000)
        found = licence_model.scan(text)
        assert [f[0] for f in found] == ["Apache-2.0", "MIT"]
        assert text[found[0][1]:found[0][2]] == "Licensed under the Apache License, Version 2.0" and "MIT License" in text[found[1][1]:found[1][2]]


def test_short_forms_and_signs(licence_model):
    for family, templates in licences.TEMPLATES.items():
        for template in templates:
            assert licence_model.signs & set(licences.words_of(template)), template
            assert {f[0] for f in licence_model.scan(template)} == {family}, template
    for text, family in (("Distributed under GPLv3", "GPL"), ("Released under LGPL-2.1", "LGPL"), ("MPL 2.0", "MPL-2.0"),
                         ("SPDX-License-Identifier: GPL-3.0-or-later", "GPL"), ("Licensed under AGPL-3.0", "AGPL"), ("BSD-3-Clause", "BSD")):
        assert [f[0] for f in licence_model.scan(prose(2, 50) + "\n" + text + "\n" + prose(3, 50))] == [family], text


# ---- mixing ---------------------------------------------------------------------

def test_op9_query(spark):
    assert differences(QUERIES["op9_mix_sources"](spark, FOLDER), open_tables(FOLDER), SQL["op9_mix_sources"]) == ""


def test_mixing_of_odd_rows(spark, odd, nothing):
    found = mixing.mix(odd).collect()
    sizes = collections.Counter()
    for r in ROWS:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    # Weights by name, null last: a 3, b 1, c 2, null 3; no source over twice its size.
    weights, total = {"a": 3, "b": 1, "c": 2, None: 3}, 1.5 * sum(sizes.values())
    target, free = {}, set(sizes)
    while free:
        level = (total - sum(target.values())) / sum(weights[s] for s in free)
        full = {s for s in free if level * weights[s] > 2 * sizes[s]}
        target |= {s: 2 * sizes[s] for s in full} if full else {s: level * weights[s] for s in free}
        free = free - full if full else set()
    assert len(found) == len(ROWS)
    taken = collections.Counter()
    of = {s: t for s, t in ((sizes[s], s) for s in sizes)}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        assert math.isclose(r.target, target[of[r.source_size]])
        taken[of[r.source_size]] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1
    assert sorted(map(tuple, mixing.mix(odd).collect()), key=key) == sorted(map(tuple, found), key=key)
    whole = mixing.mix(odd, whole=True).collect()
    assert all(r.part in (0, r.size) for r in whole)
    assert mixing.mix(nothing).collect() == []


@pytest.mark.parametrize("share", [0.2, 2.0])
def test_mixing_epochs_precede_the_fraction(spark, share):
    df = spark.range(400).selectExpr("id as doc_id", "'w w w w w' as text", "if(id < 133, 'hot', 's' || id % 3) as source")
    for r in mixing.mix(df, total_share=share).collect():
        assert r.epochs == math.floor(r.target / r.source_size) and r.taken == r.epochs * r.size + r.part
