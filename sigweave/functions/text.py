"""Text and JSON forms of messages and pairs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigweave.schema import FIELDS

# Two-character escapes of the text format; a backslash is escaped first.
ESCAPES = {
    "\\": "\\\\",
    '"': '\\"',
    "'": "\\'",
    "\a": "\\a",
    "\b": "\\b",
    "\f": "\\f",
    "\n": "\\n",
    "\r": "\\r",
    "\t": "\\t",
    "\v": "\\v",
}

# Text of printable characters and short escapes only, and text that needs no escape at all.
_PLAIN = r"^[ -~\x07-\x0D]*\z"
_CLEAN = r"^[ !#-&(-\[\]-~]*\z"


def _short_escapes(text: Column) -> Column:
    for char, escape in ESCAPES.items():
        text = F.replace(text, F.lit(char), F.lit(escape))
    return text


def _byte_escapes(text: Column) -> Column:
    """For text with other characters: each byte of it, those not printable as octal."""
    digits = F.hex(F.encode(text, "UTF-8"))
    starts = F.sequence(F.lit(1), F.length(digits) - 1, F.lit(2))

    def one(start: Column) -> Column:
        code = F.conv(F.substr(digits, start, F.lit(2)), 16, 10).cast("int")
        octal = F.concat(F.lit("\\"), F.lpad(F.conv(code.cast("string"), 10, 8), 3, "0"))
        short = code.between(32, 126) | code.between(7, 13)
        return F.when(short, _short_escapes(F.chr(code))).otherwise(octal)

    return F.array_join(F.transform(starts, one), "")


def quoted(text: Column) -> Column:
    body = F.when(text.rlike(_PLAIN), _short_escapes(text)).otherwise(_byte_escapes(text))
    return _in_quotes(body)


def _in_quotes(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _simple_lines(message: Column) -> Column:
    """Left-out fields take no line: the concatenation skips NULL."""
    values = {
        f: message[f].cast("string") if f == "sequence_number" else _in_quotes(message[f])
        for f in FIELDS
    }
    return F.concat_ws(
        "", *[F.concat(F.lit(f"{f}: "), v, F.lit("\n")) for f, v in values.items()]
    )


def _escaped_lines(message: Column) -> Column:
    fields = F.array(
        *[
            F.struct(F.lit(f).alias("name"), message[f].cast("string").alias("value"))
            for f in FIELDS
        ]
    )

    def line(field: Column) -> Column:
        value = F.when(field["name"] == "sequence_number", field["value"]).otherwise(
            quoted(field["value"])
        )
        return F.concat(field["name"], F.lit(": "), value, F.lit("\n"))

    return F.array_join(F.transform(fields, line), "")


def message_text(message: Column) -> Column:
    """One `name: value` line per present field, in field order, each with its line end. A
    message without special characters, which one look at all of it tells, needs no escapes."""
    texts = [message[f] for f in FIELDS if f != "sequence_number"]
    clean = F.concat_ws("", *texts).rlike(_CLEAN)
    return F.when(clean, _simple_lines(message)).otherwise(_escaped_lines(message))


def pair_text(first: Column, second: Column) -> Column:
    return F.concat(message_text(first), F.lit("\n"), message_text(second))


def pair_json(first: Column, second: Column, response_time: Column, seq_id: Column) -> Column:
    def fields(message: Column) -> Column:
        return F.struct(*[message[f].alias(f) for f in FIELDS])

    return F.to_json(
        F.struct(
            seq_id.alias("seq_id"),
            response_time.alias("response_time"),
            fields(first).alias("first"),
            fields(second).alias("second"),
        )
    )
