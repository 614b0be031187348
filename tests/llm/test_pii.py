"""Personal data: SQL, a plain reading of the patterns, edge rows and redaction."""

import hashlib
import random
import re

from pitchside.llm import pii, registry
from tests.compare import compare, duck

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(n):
    d = [int(c) for c in reversed(n)]
    return sum(d[::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0


def plain(text):
    text, out = text or "", []
    for rank, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text):
            n = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                  "card": lambda: 14 <= len(n) <= 19 and luhn(n), "phone": lambda: 10 <= len(n) <= 15}[kind]()
            if ok:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


TEXTS = [
    None, "", "a@b.c", "a@b.com_x@y.com", "a@b..c x@y-.z- @q.r a@b", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.02.3.4 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (323) 555-9830.", "+1 23", "é+49 30 1234567 ñ a.b@c.de",
    "9" * 50000, "a" * 50000, "a@" * 20000, "1." * 20000, "+1" + " " * 20000, "x@y.z " * 3000, "1-" * 30000 + "1",
    "😀 a@b.co 😀 10.0.0.1 4111111111111111",
    "IBAN DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432, xGB82WEST12345698765432",
]


def test_sql(spark):
    ok, msg = compare(registry.QUERIES["op8_pii"](spark, SF), duck(SF), registry.ORACLE_SQL["op8_pii"])
    assert ok, msg


def test_plain_reading(spark):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab1 2.9@+-()_é") for _ in range(rng.randrange(60))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("pii", pii.F.lit("x"))
    got = {r["doc_id"]: r for r in pii.find_pii(df).collect()}
    for i, text in enumerate(texts):
        base = [s for s in got[i]["pii"] if s["kind"] != "iban"]
        assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in base) == plain(text), text
    assert pii.find_pii(df.limit(0)).count() == 0


def test_added_kind_and_scores(spark):
    df = spark.createDataFrame([(1, TEXTS[-1]), (2, "xGB82WEST12345698765432"), (3, "GB82WEST12345698765433"),
                                (4, "bank xGB82WEST12345698765432"), (5, "mail a@b.co"), (6, "to a@b.co")], "doc_id long, text string")
    got = {r["doc_id"]: r["pii"] for r in pii.find_pii(df).collect()}
    count = {i: sum(s["kind"] == "iban" for s in got[i]) for i in range(1, 5)}
    assert count == {1: 2, 2: 0, 3: 0, 4: 1}
    assert got[5][0]["score"] > got[6][0]["score"]


def test_redaction(spark):
    df = spark.createDataFrame([(1, "to a@b.co from 10.0.0.1, 4111 1111 1111 1111, 4111 1111 1111 1112", 9), (2, None, 9),
                                (3, "clean 12 text", 9)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.redact_pii(df).collect()}
    assert got[1][0] == "to <EMAIL> from <IP>, <CARD>, 4111 1111 1111 1112" and got[1][1] == len(got[1][0])
    assert got[2][0] is None and got[3][0] == "clean 12 text"


def test_redaction_is_of_the_confirmed_spans(spark):
    """Redaction and find_pii agree on every text; overlapping spans give one mark, the first one's."""
    rng = random.Random(5)
    texts = [*TEXTS, "serial xGB82WEST12345698765432 in stock", "bank xGB82WEST12345698765432", "a@1.2.3.4", "+1 (555) 0100-4111 1111 1111 1111",
             "a@b.co " * 700 + "1.2.3.4", None]
    texts += ["".join(rng.choice("ab1 2.9@+-()_é4") for _ in range(rng.randrange(80))) for _ in range(800)]
    df = spark.createDataFrame([(i, t, "e", 7) for i, t in enumerate(texts)], "doc_id long, text string, _email string, _spans int")
    spans = {r["doc_id"]: r["pii"] for r in pii.find_pii(df).collect()}
    done = pii.redact_pii(df)
    assert done.columns == df.columns and "_email" in pii.find_pii(df).columns
    for r in done.collect():
        text, want, at = texts[r["doc_id"]], "", 0
        for s in spans[r["doc_id"]]:
            if s["start"] >= at:
                want += text[at:s["start"]] + f"<{s['kind'].upper()}>"
            at = max(at, s["end"])
        assert r["text"] == (None if text is None else want + text[at:])
    assert {texts[r["doc_id"]]: r["text"] for r in done.collect()}["serial xGB82WEST12345698765432 in stock"] == "serial xGB82WEST12345698765432 in stock"


def test_digest(spark):
    row = {r["doc_id"]: r for r in registry.QUERIES["op8_pii"](spark, SF).collect()}
    base = lambda s: ",".join(x for x in s.split(",") if not x.startswith("iban"))
    assert all(r["base_sha256"] == hashlib.sha256(base(r["spans"]).encode()).hexdigest() for r in row.values())
