"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

Everything is built-in expressions on one row: no shuffle, no Python. A pattern is run as
`regexp_extract_all` and `split`, which walk a text alike; the lengths of pieces and matches
give positions in code points, also where a text has many thousands of matches.

The patterns are written so that Java's matcher is linear and needs no stack per character:
possessive repeats, and a match may start only where a run of its characters starts or where
the last match ended. For base kinds neither changes what is found, for a run that fails at its
start fails at every later place. An IBAN has the length of its country, so that a word or
number behind it is not taken for a part of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Countries by the length of their IBANs, those that use them without being registered included.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_COUNTRY = "|".join("|".join(c.split()) for c in _IBAN_LENGTHS.values())
#: Other codes take a run up to the next one that begins like an IBAN.
_IBAN = "|".join(
    [rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}+" for n, c in _IBAN_LENGTHS.items()]
    + [rf"(?!{_IBAN_COUNTRY})[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]|\x20(?![A-Z]{{2}}[0-9]{{2}})[A-Z0-9]){{11,30}}+"]
)
_IP_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


@dataclass(frozen=True)
class Kind:
    """`worth` is the score of a confirmed span; context words add `_NEAR`. `sure`: kept whatever its score."""

    name: str
    needs: str
    pattern: str
    worth: float
    words: str
    sure: bool


#: In the order in which spans of equal start are listed; the first four are the base kinds.
KINDS = (
    Kind(
        "email", "@",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9, "mail|contact|write to", True,
    ),
    Kind(
        "ip", "[0-9]\\.[0-9]",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.5, "address|server|host|login|\\bip\\b", True,
    ),
    Kind(
        "card", "[0-9]",
        r"[0-9](?:[\x20-]?[0-9])++",
        0.7, "card|credit|visa|payment|account", True,
    ),
    Kind(
        "phone", "\\+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.6, "phone|call|\\btel|mobile|contact", True,
    ),
    Kind(
        "iban", "[A-Z]{2}[0-9]{2}",
        rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])",
        0.8, "iban|bank|account|transfer", False,
    ),
    Kind(
        "ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        0.3, "social|security|\\bssn\\b|tax", False,
    ),
)
_NEAR = 0.3
_CONTEXT = 40
_CHUNK = 256


def mod97(code: Column) -> Column:
    """True if letters and digits of an IBAN, blanks removed, leave 1 when divided by 97."""
    turned = F.concat(F.substring(code, 5, 34), F.substring(code, 1, 4))
    value = F.transform(F.split(turned, ""), lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(c) - 55))
    rest = F.aggregate(
        F.filter(value, lambda v: v.isNotNull() & (v >= 0)),
        F.lit(0),
        lambda r, v: (r * F.when(v > 9, 100).otherwise(10) + v) % 97,
    )
    return rest == 1


def confirmed(kind: str, match: Column) -> Column:
    """The kind's own test of a match."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return mod97(F.replace(match, F.lit(" "), F.lit("")))
    return F.lit(True)


def _spans(order: int, kind: Kind, matches: str, pieces: str) -> Column:
    """Confirmed spans (start, order, kind, end, value, score) from matches and what lies between them."""
    found, between = F.col(matches), F.col(pieces)
    n = F.size(found)
    each = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(
            F.length(between[i]).alias("gap"),
            F.length(found[i]).alias("len"),
            found[i].alias("value"),
            F.concat_ws(" ", F.right(between[i], F.lit(_CONTEXT)), F.left(between[i + 1], F.lit(_CONTEXT))).alias("near"),
        ),
    )
    # Running sums in chunks: appending to one long array would cost its square.
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / _CHUNK).cast("int")),
        lambda c: F.slice(each, c * _CHUNK + 1, F.lit(_CHUNK)),
    )
    return F.when(n > 0, F.flatten(F.transform(_with_offsets(chunks), lambda x: _placed(x, order, kind)))).otherwise(
        F.expr(_EMPTY)
    )


_SPAN = "start:int,rank:int,kind:string,end:int,value:string,score:double"
_EMPTY = f"cast(array() as array<struct<{_SPAN}>>)"
_SPOT = "cast(array() as array<struct<start:int,end:int,value:string,near:string>>)"


def _with_offsets(chunks: Column) -> Column:
    """(at, items) of every chunk, `at` being the length of all earlier ones."""
    length = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x["gap"] + x["len"]))
    return F.transform(
        F.sequence(F.lit(0), F.size(chunks) - 1),
        lambda i: F.struct(
            F.aggregate(F.slice(length, F.lit(1), i), F.lit(0), lambda a, x: a + x).alias("at"), chunks[i].alias("items")
        ),
    )


def _placed(chunk: Column, order: int, kind: Kind) -> Column:
    spots = F.aggregate(
        chunk["items"],
        F.struct(chunk["at"].alias("at"), F.expr(_SPOT).alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["len"]).alias("at"),
            F.array_append(
                a["out"],
                F.struct(
                    (a["at"] + x["gap"]).alias("start"),
                    (a["at"] + x["gap"] + x["len"]).alias("end"),
                    x["value"].alias("value"),
                    x["near"].alias("near"),
                ),
            ).alias("out"),
        ),
        lambda a: a["out"],
    )
    return F.transform(
        F.filter(spots, lambda s: confirmed(kind.name, s["value"])),
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("rank"),
            F.lit(kind.name).alias("kind"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            (F.lit(kind.worth) + F.when(F.lower(s["near"]).rlike(kind.words), _NEAR).otherwise(0.0)).alias("score"),
        ),
    )


def find(docs: DataFrame, text_col: str = "text", threshold: float = 0.5, prefix: str = "_pii") -> DataFrame:
    """`docs` with all its columns and `{prefix}_spans`: array of (start, rank, kind, end, value, score).

    Sorted by start, then in the order of `KINDS`; start and end count code points, end exclusive.
    Base kinds are kept once confirmed; the others need `threshold`, which context words help
    them reach. A null or empty text has an empty array. Rows that repeat are treated alike, and no
    column of `docs` but the text is looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    matches = {k.name: f"{prefix}_m_{k.name}" for k in KINDS}
    pieces = {k.name: f"{prefix}_p_{k.name}" for k in KINDS}
    none = F.expr("cast(array() as array<string>)")
    has = lambda k: F.contains(text, F.lit(k.needs)) if k.needs == "@" else text.rlike(k.needs)
    out = docs.withColumns(
        {matches[k.name]: F.when(has(k), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).otherwise(none) for k in KINDS}
    )
    out = out.withColumns(
        {pieces[k.name]: F.when(F.size(matches[k.name]) > 0, F.split(text, k.pattern, -1)).otherwise(none) for k in KINDS}
    )
    sure = [k for k in KINDS if k.sure]
    rest = [(i, k) for i, k in enumerate(KINDS) if not k.sure]
    spans = [_spans(i, k, matches[k.name], pieces[k.name]) for i, k in enumerate(sure)]
    spans += [
        F.filter(_spans(i, k, matches[k.name], pieces[k.name]), lambda s: s["score"] >= threshold) for i, k in rest
    ]
    return out.withColumn(f"{prefix}_spans", F.array_sort(F.concat(*spans))).drop(*matches.values(), *pieces.values())


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(
        ",",
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
    )


def masked(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """`docs` with every span of the text replaced by its kind in angle brackets; null stays null.

    Overlapping spans are replaced as one, under the first one's kind.
    """
    found = find(docs, text_col, threshold)
    text = F.col(text_col)
    state = "cast(array() as array<string>)"
    built = F.aggregate(
        F.col("_pii_spans"),
        F.struct(F.lit(0).alias("at"), F.expr(state).alias("out")),
        lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.when(s["start"] < a["at"], a["out"]).otherwise(
                    F.concat(
                        a["out"],
                        F.array(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">"))),
                    )
                ).alias("out"),
            )
        ),
        lambda a: F.concat(F.concat_ws("", a["out"]), F.substring(text, a["at"] + 1, F.length(text))),
    )
    return found.withColumn(text_col, F.when(F.size("_pii_spans") > 0, built).otherwise(text)).drop("_pii_spans")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per row of `docs`: doc_id, counts of base kinds, base_sha256, spans, counts of added kinds.

    Cases as in `find`; a null id stays null.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = find(narrow, "text", threshold).drop("text")
    spans = F.col("_pii_spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda s: s["rank"] < 4)
    return found.select(
        "doc_id",
        *[count(k.name).alias(f"n_{k.name}") for k in KINDS if k.sure],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
        *[count(k.name).alias(f"n_{k.name}") for k in KINDS if not k.sure],
        F.transform(spans, lambda s: F.round(s["score"], 2)).alias("scores"),
    )
