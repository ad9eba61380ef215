import re
import time

from plexlake.llm import pii

from .helpers import frame

# the plain forms that the contract states
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    text, digits = text or "", lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


TEXTS = [
    "a@b.c%d@e.f x@y z@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.04 1.2.3", "4111 1111 1111 1111-4111111111111111 5",
    "call +1 (2)3-45.6789+12345678901 or +49 30 1234567", "\U0001f600é me@x.org, GB82 GB82WEST12345698765432 DE89370400440532013000 DE00370400440532013000",
    None, "", "@@..a@b.c.d.e..f", "+" * 50 + "1" * 5000, "a" * 20000 + "@b.c", "1 2-3 4 5-6 7 8 9-0 1 2", "4111-1111-1111-1111 4111 1111 1111 1112",
    "x@y.z " * 400, "+1" * 100, "1.1.1.1" * 30, "9" * 16 + " " + "0" * 16, "a@b@c.d@e.f-g", "no data here\n",
]


def test_spans_equal_the_plain_rules(spark):
    docs = frame(spark, TEXTS).withColumnRenamed("source", "spans")
    got = {r.doc_id: [(s.start, s.rank, s.end) for s in r.spans] for r in pii.find_spans(docs).collect()}
    for i, text in enumerate(TEXTS):
        assert [s for s in got[i] if s[1] < 4] == plain_spans(text), text
    ibans = [TEXTS[4][s[0] : s[2]] for s in got[4] if s[1] == 4]
    assert ibans == ["GB82WEST12345698765432", "DE89370400440532013000"]


def test_words_nearby_move_the_score(spark):
    texts = ["host 10.0.0.1 up", "version 10.0.0.1 out", "so 10.0.0.1 is"]
    scores = [r.spans[0].score for r in pii.find_spans(frame(spark, texts)).orderBy("doc_id").collect()]
    assert scores[0] > scores[2] > scores[1]


def test_redaction(spark):
    texts = ["mail a@b.c now", "a@b.c", None, "", "1.2.3.4 and 4111111111111111.", "none"]
    docs = frame(spark, texts).withColumnRenamed("source", "_spans")
    done = pii.redacted(docs)
    assert done.columns == docs.columns
    rows = {r.doc_id: r for r in done.collect()}
    assert [rows[i].text for i in range(6)] == ["mail [EMAIL] now", "[EMAIL]", None, "", "[IP] and [CARD].", "none"]
    assert rows[0].n_chars == len(rows[0].text) and rows[2].n_chars == 0
    assert pii.redacted(docs.limit(0)).count() == 0


def test_printed_ibans(spark):
    printed = ["DE89 3704 0044 0532 0130 00", "GB82-WEST-1234-5698-7654-32", "NO93 8601 1117 947", "GB82WEST12345698765432", "FR14 2004 1010 0505 0001 3M02 606", "DE893704004405320130 00"]
    texts = [f"to {iban}{after}" for iban in printed for after in ("", " 5 EUR", " BIC COBADEFF", ", now", "-A")]
    texts += ["DE88 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 005", "DE89  3704 0044 0532 0130 00", "XDE89 3704 0044 0532 0130 00"]
    rows = {r.doc_id: r for r in pii.find_spans(frame(spark, texts).withColumnRenamed("source", "spans")).collect()}
    for i, text in enumerate(texts[:30]):
        found = [text[s.start : s.end] for s in rows[i].spans if s.kind == "iban"]
        assert found == [printed[i // 5]], text
    assert not any(s.kind == "iban" for i in range(30, len(texts)) for s in rows[i].spans)
    done = {r.doc_id: r.text for r in pii.redacted(frame(spark, texts)).collect()}
    assert done[3] == "to [IBAN], now" and done[0] == "to [IBAN]"


def test_pieces_and_long_dense_texts(spark, monkeypatch):
    texts = [x for x in TEXTS if x] + ["\U0001f600" * 253 + " a@b.c " + "é" * 600 + " mail 10.1.2.3 " + "x" * 251 + " 1.2.3.4"]
    docs = frame(spark, texts)
    wide = {r.doc_id: (r.text, r.spans) for r in pii.redact(pii.find_spans(docs), 0.0).collect()}
    monkeypatch.setattr(pii, "PIECE_BITS", 1)
    small = {r.doc_id: (r.text, r.spans) for r in pii.redact(pii.find_spans(docs), 0.0).collect()}
    assert small == wide
    for i, text in enumerate(texts):
        out, at = "", 0
        for s in wide[i][1]:
            out += text[at : s.start] + f"[{s.kind.upper()}]" if s.start >= at else ""
            at = max(at, s.end)
        assert wide[i][0] == out + text[at:]


def test_a_hundred_thousand_addresses_in_a_text(spark):
    text = "".join(f"write to u{i}@example.org or 10.0.{i % 300}.1\n" for i in range(50_000))
    docs = spark.createDataFrame([(1, text, len(text))], "doc_id long, text string, n_chars long")
    started = time.perf_counter()
    row = pii.find_spans(docs).selectExpr("spans").first()
    want = [(s, k, e) for s, k, e in plain_spans(text)]
    assert [(s.start, s.rank, s.end) for s in row.spans] == want
    done = pii.redacted(docs).first()
    assert time.perf_counter() - started < 120  # work that grew with the square of the spans would take hours
    assert done.text == re.sub(r"10\.0\.[0-9]+\.1", lambda m: "[IP]" if int(m[0].split(".")[2]) < 256 else m[0], re.sub(r"u[0-9]+@example\.org", "[EMAIL]", text))
    assert done.n_chars == len(done.text)
