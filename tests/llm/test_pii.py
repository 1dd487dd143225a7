"""Base spans against plain regular expressions; added spans and redaction."""

import hashlib
import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import pii, queries

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def slow_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), n, m.end()))
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{list(PLAIN)[n]}:{a}:{b}" for a, n, b in spans).encode()).hexdigest()


def test_query_equals_plain_patterns(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op3_pii(spark, SF).collect()
    assert len(rows) == len(docs) and any(r.n_email for r in rows) and any(r.n_card for r in rows)
    for r in rows:
        spans = slow_spans(docs[r.doc_id])
        assert r.base_sha256 == digest(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == n for s in spans) for n in range(4)]
        listed = [x.split(":") for x in r.spans.split(",") if x]
        assert {f"{list(PLAIN)[n]}:{a}:{b}" for a, n, b in spans} <= set(r.spans.split(","))
        assert listed == sorted(listed, key=lambda x: (int(x[1]), pii.KINDS.index(x[0])))
    secrets = {i for i, t in docs.items() if re.search(r'token = "[0-9a-f]{40}"|AKIA[0-9A-Z]{16}|password=[0-9a-f]+', t)}
    added = {r.doc_id for r in rows if "secret:" in r.spans}
    assert len(secrets & added) > 0.8 * len(secrets)
    assert len(added - secrets) <= 0.02 * len(docs)


def test_hard_texts(spark):
    rng = random.Random(5)
    pool = ["a@b.c", "@", "+1 (", "555", "-", " ", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "é", "\U0001F600", "_", "x", "(", ")",
            "\n", "007.0.0.255", "+49 30 1234567", "%"]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 14))) for _ in range(400)]
    texts += [None, "", "1" * 30000, "1." * 20000, "a" * 50000, "a@" + "b." * 20000 + "c", "+1" + "(" * 20000, "a@b.c_x@d.e", "1.2.3.4.5.6.7.8",
              "+" * 30000, "4" + " 4" * 20000, "a@b.c@d.e.f", "a.b" * 15000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    for r in pii.find(docs, pii.Model((), {})).collect():
        assert [tuple(s) for s in r.base] == slow_spans(texts[r.doc_id]), texts[r.doc_id][:80]
        assert r.base == r.spans


def test_edge_rows_and_redaction(spark):
    docs = spark.createDataFrame([(None, "mail me@x.org, é +1 234 567 8901!"), (1, None), (1, None)], "doc_id long, text string")
    assert pii.train(docs).trees == ()
    found = pii.find(docs, pii.train(docs))
    rows = found.select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("clean")).collect()
    assert sorted(map(str, rows)) == sorted(map(str, [
        type(rows[0])(doc_id=None, clean="mail [EMAIL], é [PHONE]!"), type(rows[0])(doc_id=1, clean=""), type(rows[0])(doc_id=1, clean="")]))
    assert pii.find(docs.limit(0), pii.Model((), {})).collect() == []


def iban(country, account):
    number = "".join(str(int(c, 36)) for c in f"{account}{country}00")
    return f"{country}{98 - int(number) % 97:02d}{account}"


def test_planted_identifiers_and_national_phones(spark):
    rng = random.Random(8)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    plain = lambda n: " ".join(rng.choices(["report", "of", "the", "week", "12", "Ab3", "3.5"], k=n))
    rows, planted = [], {}
    for i in range(400):
        kind = ("ssn", "iban", "spaced", "called", "national", "abroad", "ip", "none")[i % 8]
        body = {"ssn": f"{rng.randint(100, 600)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}", "iban": iban("DE", digits(18)),
                "called": f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{digits(4)}", "national": f"({rng.randint(200, 999)}) {digits(3)}-{digits(4)}",
                "abroad": f"+1 ({rng.randint(200, 999)}) {digits(3)}-{digits(4)}", "ip": ".".join(str(rng.randint(100, 255)) for _ in range(4)), "none": "nothing 000-12-3456"}.get(kind)
        if kind == "spaced":
            whole = iban("ES", digits(20))
            body = " ".join(whole[n: n + 4] for n in range(0, 24, 4))
        before, after = plain(6) + (" phone: " if kind == "called" else " see "), (" PAID NOW " if kind == "spaced" else " and ") + plain(5)
        rows.append((i, before + body + after, 0))
        if kind in ("ssn", "iban", "spaced", "called", "national"):
            planted[i] = ("phone" if kind in ("called", "national") else "id", len(before), len(before) + len(body), body)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    model = pii.train(docs)
    found = pii.find(docs, model).select("doc_id", "base", pii.listing(F.col("spans")).alias("spans")).collect()
    free = {r.doc_id for r in found if not r.base}  # digits of an IBAN may pass for a card, whose span is then the base one
    spans = {r.doc_id: set(r.spans.split(",")) for r in found}
    assert len(free & set(planted)) > 0.9 * len(planted)
    assert [(rows[i][1], spans[i]) for i in sorted(free & set(planted)) if "{}:{}:{}".format(*planted[i][:3]) not in spans[i]] == []
    assert all(not any(x.startswith(("id:", "phone:")) for x in spans[i]) for i in range(7, 400, 8))
    clean = {r.doc_id: r.text for r in corpus_pipeline.redact_pii(spark, docs, "").collect()}
    assert not any(planted[i][3] in clean[i] for i in free & set(planted))
    alone = docs.where("doc_id = 0")  # nothing to train on
    assert [r.text for r in corpus_pipeline.redact_pii(spark, alone, "").collect()] == [rows[0][1].replace(planted[0][3], "[ID]")]


def test_long_secrets_and_tokens_without_digits(spark):
    rng = random.Random(12)
    token = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    texts = [f'see token = "{token(40)}" and then some words' for _ in range(60)] + [f"the 12 plainwordsrunninglong{'abcdefgh'[i % 8]} end" for i in range(60)]
    secrets = [token(300), "Ab1_" * 500]
    texts += [f'call token = "{s}" end' for s in secrets] + [f"{w}{'Q' * 10}{'Z' * 10} is scored by one rule" for w in ("", "1 and ")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.train(docs)
    listed = {r.doc_id: r.spans for r in pii.find(docs, model._replace(thresholds={pii.KINDS.index("secret"): -1e9})).select(
        "doc_id", pii.listing(F.col("spans")).alias("spans")).collect()}
    assert [listed[120 + i] for i in range(2)] == [f"secret:14:{14 + len(s)}" for s in secrets]
    assert listed[122] == listed[123] == ""  # no digit in the token, whatever stands beside it
    clean = [r.clean for r in pii.find(docs, model).where("doc_id IN (120, 121)").select(pii.redact(F.col("text"), F.col("spans")).alias("clean")).collect()]
    assert clean == ['call token = "[SECRET]" end'] * 2


def test_the_trees_learn_from_all_texts(spark, monkeypatch):
    docs = spark.range(30_000).select("id", F.format_string("phone: 555-%03d-%04d", F.col("id") % 1000, F.col("id") % 9973).alias("text"))
    listed = []
    monkeypatch.setattr(pii, "materialize", lambda df, label: listed.append(df.count()) or df)
    pii.train(docs)
    assert listed == [30_000]
