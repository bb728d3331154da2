"""Personal data against a plain version; disclosing terms; sanitised texts."""

import hashlib
import itertools
import math
import re
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from adit.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(k, m[0]))


TRICKY = [
    "a@b.c_x@d.e f@g..h i@j.k.l@m.n @x.y a@b",
    "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004 1234.1.1.1 0000000001.2.3.4",
    "4111 1111 1111 1111-1 4111-1111-1111-1111 4111  1111 11111111 " + "1" * 40,
    "+1 (234) 567-8901) +12 +1((( +905551234567- ++4915112345678",
    "x" * 3000 + "@" + "y" * 3000 + "." + "z" * 10,
    "é😀 a@b.co 😀 1.2.3.4 😀 +90 555 123 45 67",
    "1 2" * 3000,
    "a." * 5000,
    None,
    "",
]


def test_base_spans_match_a_plain_version(spark, documents, awkward, empty):
    tricky = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    for docs in (documents, tricky, awkward):
        texts = {}
        for r in docs.collect():
            texts.setdefault(r["doc_id"], r["text"])
        found = pii.personal_data(docs).select("doc_id", pii.listed(pii.KINDS).alias("spans")).collect()
        assert len(found) == docs.count()
        for r in found:
            assert r["spans"] == plain(texts[r["doc_id"]])
    assert pii.personal_data(empty).count() == 0


def corpus(spark):
    rows = [(i, f"please write to {'dobrinka' if i % 3 == 0 else 'jonathan'} kolarova at secret{i % 3}@mail.example.com about the {'blue' if i % 2 else 'green'} kayak soonest") for i in range(6)]
    rows += [(100 + i, "the ordinary kayak about number text please write at kolarova") for i in range(50)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_disclose_an_entity_are_spans(spark):
    found = pii.personal_data(corpus(spark))
    rows = {r["doc_id"]: r for r in found.select("doc_id", pii.listed((*pii.KINDS, "term")).alias("s")).collect()}
    assert rows[0]["s"] == "email:37:61,term:16:24"
    assert rows[100]["s"] == ""
    texts = {r["doc_id"]: r["text"] for r in pii.sanitised(found).collect()}
    assert texts[0] == "please write to  kolarova at [EMAIL] about the green kayak soonest"
    assert texts[1] == "please write to [TERM] kolarova at [EMAIL] about the blue kayak soonest"
    assert texts[100].startswith("the ordinary kayak")


def test_broadcast_and_shuffled_terms_agree(spark):
    rows = pii.base_spans(corpus(spark))
    one, two = (pii.term_spans(rows, *pii.disclosing_terms(rows, broadcast_rows=n), broadcast_rows=n) for n in (50_000, 0))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(one) == key(two) != []


def test_shares_are_counts_over_all_documents(spark):
    rows = pii.base_spans(corpus(spark))
    judged, _ = pii.disclosing_terms(rows)
    found = {(r["term"], r["entity"]): r["share"] for r in judged.collect()}
    assert found[("dobrinka", "email:secret0@mail.example.com")] == 1.0
    assert found[("jonathan", "email:secret1@mail.example.com")] == 0.5
    assert not any(t == "kolarova" for t, _ in found)


def test_query_digest(spark):
    rows = pii.op3_pii(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        assert r["base_sha256"] == hashlib.sha256(plain(texts[r["doc_id"]]).encode()).hexdigest()
        assert r["spans"].startswith(plain(texts[r["doc_id"]]))


def signed(spark, id_of):
    """Five texts with one signature line; a short name, a code and a far-off word go with its address."""
    def filler(i):
        return " ".join(f"{w}{x}" for w in ("blue", "kayak", "river") for x in "abcdefghij"[i % 5 :])

    rows = [(id_of(i), f"İlknur {filler(i)}\nAli K7 王 <ali@mail.example.com>") for i in range(5)]
    rows += [(100 + i, f"{filler(i)} row {i}") for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_short_coded_and_distant_terms_of_one_signature(spark):
    for id_of in (lambda i: i, lambda i: None):
        rows = pii.base_spans(signed(spark, id_of))
        judged = {(r["term"], r["entity"]): r["share"] for r in pii.disclosing_terms(rows)[0].collect()}
        entity = "email:ali@mail.example.com"
        assert judged == {(t, entity): 1.0 for t in ("ali", "k7", "王", "ilknur".replace("i", "i\u0307", 1))}
        for r in pii.personal_data(signed(spark, id_of)).collect():
            if "Ali" in r["text"]:
                assert [r["text"][s["start"] : s["end"]] for s in r["term"]] == ["İlknur", "Ali", "K7", "王"]
            else:
                assert not r["term"]


def test_copies_of_one_text_are_no_evidence(spark):
    rows = [(i, "Ali K7 ali@mail.example.com") for i in range(5)] + [(100 + i, f"row {i}") for i in range(60)]
    assert pii.disclosing_terms(pii.base_spans(spark.createDataFrame(rows, "doc_id long, text string")))[0].count() == 0


def plain_disclosure(texts, contexts=2):
    """Judged (term, entity, share, bits) and the term spans of each text, counted by hand."""
    word = regex.compile(r"[\p{L}\p{M}\p{N}]+")
    docs = []
    for text in texts:
        found = [(k, m.start(), m.end(), m[0]) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(k, m[0])]
        hidden = list(text or "")
        for _, start, end, _ in found:
            hidden[start:end] = " " * (end - start)
        at = [(m.start(), m.end(), m[0].lower()) for m in word.finditer("".join(hidden))]
        docs.append((text or "", {f"{k}:{v.lower()}" for k, _, _, v in found}, at))
    n_e, n_t, n_et, seen = Counter(), Counter(), Counter(), {}
    for text, entities, at in docs:
        terms = {t for _, _, t in at}
        n_e.update(entities)
        n_t.update(terms)
        for pair in itertools.product(entities, terms):
            n_et[pair] += 1
            seen.setdefault(pair, set()).add(text)
    judged = {(t, e): (n / n_t[t], math.log2(n / n_t[t] * len(texts) / n_e[e])) for (e, t), n in n_et.items() if len(seen[e, t]) >= contexts}
    judged = {k: v for k, v in judged.items() if v[0] >= pii.SHARE and v[1] >= pii.BITS}
    wanted = {t for t, _ in judged}
    return judged, [[(a, b) for a, b, t in at if t in wanted] for _, _, at in docs]


def test_disclosure_is_that_of_a_plain_count(spark, documents):
    rows = [r["text"] for r in documents.select("text").collect()]
    base = " ".join(rows[3].split()[:40])
    planted = [f"{base} {k} Ayşe Öz 77{k % 2} wrote ΑΣ from ayse@mail.example.com and 10.0.{k % 3}.7 ΟΔΟΣ, ΣΑ" for k in range(9)]
    planted += ["ayse@mail.example.com Öz", "Ayşe 10.0.1.7 ayse", planted[0], "ΑΣ ΣΑ.Β", "10 0 1 7 mail"]
    texts = rows + planted
    judged, places = plain_disclosure(texts)
    assert len({t for t, _ in judged}) > 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r["term"], r["entity"]): (r["share"], r["bits"]) for r in pii.disclosing_terms(pii.base_spans(docs))[0].collect()}
    assert found.keys() == judged.keys()
    for k, v in judged.items():
        assert found[k] == pytest.approx(v)
    for r in pii.personal_data(docs).select("doc_id", "term").collect():
        assert [(s["start"], s["end"]) for s in r["term"]] == places[r["doc_id"]]


def test_terms_are_generalised_by_kind_and_the_query_tells(spark):
    forms = spark.createDataFrame([("77",), ("a7",), ("ab",)], "t string").select(pii.general_form(F.col("t"))).collect()
    assert [r[0] for r in forms] == ["[NUMBER]", "[CODE]", "[TERM]"]
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in pii.sanitised(pii.personal_data(spark.read.parquet(f"{folder}/documents.parquet"))).collect()}
    for r in pii.op3_pii(spark, folder).collect():
        assert r["sanitised_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_long_lists_of_entities_are_paired_by_sets(spark):
    """Two different lists of the same 3,000 addresses and 9,000 names: one set of each, in seconds."""
    people = [f"name{k} street{k} city{k} a{k}@mail.example.com" for k in range(3_000)]
    rows = [(0, " ".join(people)), (1, "again " + "\n".join(reversed(people)))] + [(100 + i, f"row {i} of texts again") for i in range(60)]
    found = pii.base_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    judged, members, _ = pii._classes(found)
    assert judged.count() == 9_000 and judged.select("set").distinct().count() == 1
    assert members.count() == 3_000
    spans = {r["doc_id"]: r["term"] for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(spans[0]) == len(spans[1]) == 9_000 and not spans[100]
    assert [rows[1][1][s["start"] : s["end"]] for s in spans[1][:3]] == ["name2999", "street2999", "city2999"]


@pytest.mark.parametrize("contexts", [1, 2, 4])
def test_sets_that_overlap_in_part(spark, contexts):
    """Lists that share parts of their addresses and words, with copies, against a plain count."""
    rows = []
    for i in range(24):
        parts = [f"w{k} x{k % 7} a{k % 9}@mail.example.com" for k in range(40) if (k * (i + 1)) % 5 < 2]
        rows += [(i, " ".join(parts) + f" tail{i % 6}")] * (1 + i % 3)
    rows += [(100 + i, f"w{i % 40} ordinary text x{i % 7} number") for i in range(400)]
    judged, _ = plain_disclosure([t for _, t in rows], contexts)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["term"], r["entity"]): (r["share"], r["bits"]) for r in pii.disclosing_terms(pii.base_spans(docs), contexts=contexts)[0].collect()}
    assert judged and found.keys() == judged.keys()
    for k, v in judged.items():
        assert found[k] == pytest.approx(v)
