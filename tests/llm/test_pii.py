"""Personal data: base spans by brute force, disclosure by hand, sanitised texts."""

import hashlib
import math
import re

from pyspark.sql import functions as F

from pipewatch.llm import pii

TEXTS = [
    None,
    "",
    "mail a.b+c@x-y.example.com, a@b.c_x@y.z @a.b x@y 🙂é@q.w.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.000.1.1 1.2.3 999999999999.1.1.1 192.168.0.1.",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 5 4929123456781234567",
    "call +1 (487) 555-7209 or +49.30.123456 +1 +12 3 +1234567890123456 ++44 20 7946 0958)",
    "x" * 50_000 + "@" + "y." * 3000 + "z",
    "1" * 50_000 + " " + "1.2" * 5000 + " " + "+1" + " 2" * 9000,
    "é" * 10 + "a@b.co" + "ü" * 10 + "+4420794609581",
]


def brute(text):
    text, out = text or "", []
    for kind, pattern in pii.PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                twice = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1])) if 16 <= len(digits) <= 19 else 1
                if twice % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def check(rows, texts):
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in pii.PLAIN]
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("term")] == want
        assert len(spans) - len(want) == r.n_terms


def test_base_spans_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("kind", F.lit("clash"))
    rows = pii.find_personal_data(docs).collect()
    assert len(rows) == len(TEXTS)
    check(rows, TEXTS)
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_base_spans_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(pii.find_personal_data(docs).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_revealing_terms(spark):
    texts = ["the zorblax of joe@x.com met the king", "the zorblax and joe@x.com the king", *["the king is here"] * 30, *["other words"] * 68]
    docs = spark.createDataFrame([*enumerate(texts), (None, "joe@x.com"), (None, "joe@x.com")], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    for doc in (0, 1):
        terms = [s.split(":")[1:] for s in rows[doc].spans.split(",") if s.startswith("term")]
        assert [texts[doc][int(a) : int(b)] for a, b in terms] == ["zorblax"]
    assert all(r.n_terms == 0 for k, r in rows.items() if k not in (0, 1))
    # Of 102 documents four have the entity and two the term, both with the entity.
    assert math.isclose(math.log(2 * 102 / (4 * 2)) / math.log(102 / 4), 1.0)
    clean = {(r.doc_id, r.text) for r in pii.sanitise(docs).collect()}
    assert {(0, "the  of [EMAIL] met the king"), (1, "the  and [EMAIL] the king"), (2, "the king is here"), (None, "[EMAIL]")} <= clean
    assert pii.sanitise(docs).count() == 102


def test_sanitise_keeps_nulls_columns_and_the_rest(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("start", F.lit(7))
    got = pii.sanitise(docs)
    assert got.columns == docs.columns
    out = {r.doc_id: r.text for r in got.collect()}
    assert out[0] is None and out[1] == "" and out[8] == "é" * 10 + "[EMAIL]" + "ü" * 10 + "[PHONE]"
    assert out[3] == "[IP].[IP] 256.1.1.1 [IP] 1.2.3 999999999999.1.1.1 [IP]."


def test_revealing_terms_far_away_and_without_the_entity(spark):
    far = "the king is here " * 20
    texts = [
        f"Zorblax, {far} joe@x.com", f"{far} joe@x.com {far} zorblax {far} ZORBLAX", "of Zorblax alone",
        # A part of a longer word is another term, in letters beyond 16 bits too.
        "zorblaxes \U00010400zorblax zorblax\U00010400 xzorblax", *[f"{far} other words"] * 196,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # Of 200 documents two have the entity and three the term, two of them the entity also.
    assert pii.GENERALISE <= math.log(2 * 200 / (2 * 3)) / math.log(200 / 2) < pii.REMOVE
    rows = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert [rows[i].n_terms for i in range(5)] == [1, 2, 1, 0, 0]
    assert rows[2].spans == "term:3:10"
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[0] == f"[TERM], {far} [EMAIL]" and clean[1] == f"{far} [EMAIL] {far} [TERM] {far} [TERM]"
    assert clean[2] == "of [TERM] alone" and all(clean[i] == texts[i] for i in range(3, 200))


def test_an_entity_of_every_document_reveals_nothing(spark):
    docs = spark.createDataFrame([(1, "write to joe@x.com today")] * 2, "doc_id long, text string")
    assert [r.n_terms for r in pii.find_personal_data(docs).collect()] == [0, 0]
    assert [r.text for r in pii.sanitise(docs).collect()] == ["write to [EMAIL] today"] * 2
