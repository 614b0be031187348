"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Everything is a DataFrame expression.  For each kind the text is split at the pattern and the
matches are taken out; the running lengths of pieces and matches give the places in code points.
A proposed span fails or passes its check (octets of an address, Luhn, digit counts, mod 97).
Its score is the kind's own, raised if a context word stands within ``WINDOW`` characters.  Base
kinds (email, ip, card, phone) stay whatever their score; an ``iban`` needs ``min_score``: one
that is cut out of a longer run of letters and digits passes only beside a context word.

The patterns are written with possessive loops, which Java runs without recursion, and start only
where a run starts, so that long runs cost linear time; both leave the matches as they are with
plain greedy loops.

Cases: null text counts as empty (no span; redaction keeps it null); very long texts are read
whole; repeated rows are treated alike; empty input gives empty output; other columns travel along
unless they bear the name of an added column, which is then replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, unused

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})",
}
#: A text without a match of this has no match of the kind.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]", "iban": "[A-Z]{2}[0-9]{2}"}
SCORE = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.4}
CONTEXT = {
    "email": "mail|contact|kontakt|correo", "ip": "address|server|host|adresse", "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|call|mobile|telefon|anruf|appel", "iban": "iban|account|bank|konto|compte|cuenta",
}
WINDOW = 40
#: Length of the blocks in which places are summed, so that many matches in one text stay cheap.
BLOCK = 256


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True if the text of digits passes the Luhn check."""
    def part(i: Column) -> Column:
        d = F.ascii(F.reverse(number).substr(i, F.lit(1))) - 48
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return total(F.transform(F.sequence(F.lit(1), F.length(number)), part)) % 10 == 0


def mod97(number: Column) -> Column:
    """True if the account number, its first four characters moved to the end and letters as 10 to 35, is 1 mod 97."""
    turned = F.concat(F.substring(number, 5, 99), F.substring(number, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.split(turned, "(?!^)(?=.)"), F.lit(0), step) == 1


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        small = lambda p: let(F.ltrim(p, F.lit("0")), lambda n: F.when(
            F.length(n) <= 3, F.coalesce(n.try_cast("int"), F.lit(0)) <= 255).otherwise(False))
        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return let(digits(match), lambda n: F.when(F.length(n).between(14, 19), luhn(n)).otherwise(False))
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    if kind == "iban":
        return let(F.replace(match, F.lit(" "), F.lit("")),
                   lambda n: F.when(F.length(n).between(15, 34), mod97(n)).otherwise(False))
    return F.lit(True)


def parts(text: Column, kind: str) -> Column:
    """``(before, match)`` in the order of the text; the last has what follows the last match, and a null match."""
    p = F.lit(PATTERN[kind])
    return F.arrays_zip(F.split(text, PATTERN[kind], -1).alias("before"),
                        F.regexp_extract_all(text, p, F.lit(0)).alias("match"))


def spans_of(text: Column, kind: str, min_score: float) -> Column:
    """Confirmed spans of one kind as ``(start, rank, end, kind, score)``, places counted from 0."""
    rank, name = KINDS.index(kind), F.lit(kind)

    def located(zipped: Column) -> Column:
        n = F.size(zipped) - 1
        sizes = F.transform(zipped, lambda z: F.length(z["before"]) + F.coalesce(F.length(z["match"]), F.lit(0)))

        def with_sizes(s: Column) -> Column:
            sums = F.transform(F.sequence(F.lit(0), F.floor(n / BLOCK).cast("int")),
                               lambda b: total(F.slice(s, 1, b * BLOCK)))

            def with_sums(block: Column) -> Column:
                def place(z: Column, i: Column) -> Column:
                    b = F.floor(i / BLOCK).cast("int")
                    start = (F.get(block, b) + total(F.slice(s, b * BLOCK + 1, i % BLOCK)) + F.length(z["before"]))
                    return F.struct(start.cast("int").alias("start"), F.lit(rank).alias("rank"),
                                    (start + F.length(z["match"])).cast("int").alias("end"), name.alias("kind"),
                                    z["match"].alias("match"))

                return F.transform(F.slice(zipped, 1, n), place)

            return let(sums, with_sums)

        return let(sizes, with_sizes)

    found = let(parts(text, kind), located)
    found = F.filter(found, lambda s: valid(kind, s["match"]))

    def scored(s: Column) -> Column:
        first = F.greatest(s["start"] - WINDOW, F.lit(0))
        near = F.lower(text.substr(first + 1, s["end"] + WINDOW - first))
        score = F.lit(SCORE[kind]) + F.when(near.rlike(CONTEXT[kind]), 0.2).otherwise(0.0)
        if kind not in BASE:
            edge = F.concat(F.when(s["start"] > 0, text.substr(s["start"], F.lit(1))).otherwise(""),
                            text.substr(s["end"] + 1, F.lit(1)))
            score = score + F.when(edge.rlike("[A-Za-z0-9]"), 0.0).otherwise(0.2)
        return F.struct(s["start"], s["rank"], s["end"], s["kind"], score.alias("score"))

    found = F.transform(found, scored)
    if kind not in BASE:
        found = F.filter(found, lambda s: s["score"] >= min_score)
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>")
    return F.when(text.rlike(HINT[kind]), found).otherwise(none)


def find_pii(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The documents with ``pii``: their spans by start and kind, and a column ``n_<kind>`` for each kind."""
    docs = docs.drop("pii", *[f"n_{k}" for k in KINDS])
    text = F.coalesce("text", F.lit(""))
    each = unused(docs, *[f"_{k}" for k in KINDS])
    found = docs.withColumns({c: spans_of(text, k, min_score) for c, k in zip(each, KINDS)})
    found = found.withColumn("pii", F.array_sort(F.concat(*each)))
    return found.withColumns({f"n_{k}": F.size(c).cast("long") for c, k in zip(each, KINDS)}).drop(*each)


def redacted(text: Column, spans: Column) -> Column:
    """The text with its spans, given in order of their starts, replaced by the kind: spans that overlap
    become one, of the first one's kind."""
    def with_ends(ends: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(ends) / BLOCK).cast("int")), lambda b: F.array_max(F.slice(ends, 1, b * BLOCK)))

        def with_blocks(most: Column) -> Column:
            def head(s: Column, i: Column) -> Column:
                b = F.floor(i / BLOCK).cast("int")
                done = F.greatest(F.get(most, b), F.array_max(F.slice(ends, b * BLOCK + 1, i % BLOCK)), F.lit(0))
                return F.struct(done.alias("done"), s["start"].alias("start"), s["kind"].alias("kind"))

            heads = F.filter(F.transform(spans, head), lambda h: h["start"] >= h["done"])
            marked = F.transform(heads, lambda h: F.concat(
                text.substr(h["done"] + 1, h["start"] - h["done"]), F.lit("<"), F.upper(h["kind"]), F.lit(">")))
            return F.concat(F.array_join(marked, ""), text.substr(F.array_max(ends) + 1, F.length(text)))

        return let(blocks, with_blocks)

    return F.when(F.size(spans) > 0, let(F.transform(spans, lambda s: s["end"]), with_ends)).otherwise(text)


def redact_pii(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The documents with every span that ``find_pii`` confirms replaced by its kind, as ``<EMAIL>``;
    ``n_chars`` follows the text."""
    (spans,) = unused(docs, "_spans")
    text = F.coalesce("text", F.lit(""))
    found = docs.withColumn(spans, F.array_sort(F.concat(*[spans_of(text, k, min_score) for k in KINDS])))
    docs = found.withColumn("text", redacted(F.col("text"), F.col(spans))).drop(spans)
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("pii", lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", *[f"n_{k}" for k in BASE],
                        F.sha2(listing(base), 256).alias("base_sha256"), listing(F.col("pii")).alias("spans"))


def _sql() -> str:
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}((\x20[A-Z0-9]{4}){2,7}(\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})",
    }
    number = "regexp_replace(m, '[^0-9]', '', 'g')"
    check = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda p: len(ltrim(p, '0')) > 3 OR coalesce(try_cast(ltrim(p, '0') AS INT), 0) > 255)) = 0",
        "card": f"CASE WHEN len({number}) BETWEEN 14 AND 19 THEN list_sum(list_transform(range(1, len({number}) + 1), lambda i: "
                f"CASE WHEN i % 2 = 1 THEN reverse({number})[i]::INT WHEN reverse({number})[i]::INT > 4 THEN 2 * reverse({number})[i]::INT - 9 "
                f"ELSE 2 * reverse({number})[i]::INT END)) % 10 = 0 ELSE false END",
        "phone": f"len({number}) BETWEEN 10 AND 15",
        "iban": "CASE WHEN len(replace(m, ' ', '')) BETWEEN 15 AND 34 THEN list_reduce(list_prepend(0::BIGINT, list_transform(string_split("
                "substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4), ''), lambda c: (ascii(c) - CASE WHEN ascii(c) < 58 THEN 48 "
                "ELSE 55 END)::BIGINT)), lambda a, v: (a * CASE WHEN v < 10 THEN 10 ELSE 100 END + v) % 97) = 1 ELSE false END",
    }
    rows = "\nUNION ALL ".join(
        f"SELECT rn, '{k}' AS kind, {i} AS rank, text, unnest(regexp_extract_all(text, '{plain[k]}')) AS m, "
        f"unnest(string_split_regex(text, '{plain[k]}')[:-2]) AS before, "
        f"generate_subscripts(regexp_extract_all(text, '{plain[k]}'), 1) AS i FROM d WHERE regexp_matches(text, '{plain[k]}')"
        for i, k in enumerate(KINDS))
    tests = " ".join(f"WHEN kind = '{k}' THEN {c}" for k, c in check.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text FROM documents),
p AS ({rows}),
s AS (SELECT *, (sum(len(before) + len(m)) OVER (PARTITION BY rn, kind ORDER BY i))::BIGINT AS e FROM p),
c AS (SELECT rn, kind, rank, text, e - len(m) AS b, e FROM s WHERE CASE {tests} END),
k AS (SELECT *, kind || ':' || b || ':' || e AS item FROM c WHERE rank < 4 OR
      0.4 + CASE WHEN regexp_matches(CASE WHEN b > 0 THEN substr(text, b, 1) ELSE '' END || substr(text, e + 1, 1), '[A-Za-z0-9]') THEN 0 ELSE 0.2 END
          + CASE WHEN regexp_matches(lower(substr(text, greatest(b - {WINDOW}, 0) + 1, e + {WINDOW} - greatest(b - {WINDOW}, 0))), '{CONTEXT["iban"]}')
            THEN 0.2 ELSE 0 END >= 0.5)
SELECT d.doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
       count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
       sha256(coalesce(string_agg(item, ',' ORDER BY b, rank) FILTER (rank < 4), '')) AS base_sha256,
       coalesce(string_agg(item, ',' ORDER BY b, rank), '') AS spans
FROM d LEFT JOIN k USING (rn) GROUP BY d.rn, d.doc_id
"""


SQL = _sql()
