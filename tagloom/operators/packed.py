"""Several values packed in one field: split into one row per value, position kept.

Quoted spans are lifted out of the text into an array and replaced with indexed
placeholders, the remaining delimiters are split, spans are put back by array
lookup and the values exploded with their position. Everything is an expression
of Spark's own functions; no Python runs per row and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Brackets of a placeholder. A bracket that occurs in the data is itself escaped first.
OPEN, CLOSE, LITERAL = "\x01", "\x02", "x"
MEMBER = r"[A-Za-z0-9_:.\-]+"


def _quoted(quotes: str) -> str:
    """Pattern of one quoted span that begins a value; \\-escaped and doubled quotes stay inside."""
    spans = "|".join(rf"{q}[^{q}\\]*+(?:(?:\\.|{q}{q}|\\)[^{q}\\]*+)*+{q}" for q in quotes)
    return rf"(?s)(?<![^\s=;|{OPEN}])(?:{spans})"


#: What a pattern's \\s stands for.
BLANKS = " \t\n\x0b\x0c\r"


def _unquote(span: Column) -> Column:
    """The inside of a quoted span without outer blanks; an escaped or doubled quote stands for one."""
    quote = F.substring(span, 1, 1)
    inside = F.substring(span, F.lit(2), F.length(span) - 2)
    inside = F.when(F.instr(inside, "\\") == 0, inside).otherwise(F.regexp_replace(inside, r"\\([\"'])", "$1"))
    return _trim(F.replace(inside, F.concat(quote, quote), quote))


def _trim(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def _ltrim(text: Column) -> Column:
    return F.ltrim(text, F.lit(BLANKS))


def packed_entries(text: Column, delimiters: str = ";|", quotes: str = "\"'", fold: bool = True) -> Column:
    """``array<struct<name, value>>`` of the entries of a packed field, in order.

    An entry is a name, then blanks or an equals sign, then the value. Names come
    out in lower case (as they are without ``fold``), values without enclosing quotes and outer blanks. Blank
    entries are left out; a name alone has the value ''. Null text gives an empty
    array. A quote that is never closed is ordinary text.
    """
    pattern = _quoted(quotes)
    cased = F.lower if fold else lambda x: x
    bare = F.lit(True)
    for q in quotes:
        bare = bare & (F.instr(text, q) == 0)
    safe = F.replace(F.coalesce(text, F.lit("")), F.lit(OPEN), F.lit(f"{OPEN}{LITERAL}{CLOSE}"))
    none = F.array().cast("array<string>")
    spans = F.when(bare, none).otherwise(F.regexp_extract_all(safe, F.lit(pattern), F.lit(0)))
    gaps = F.when(bare, F.array(safe)).otherwise(F.split(safe, pattern, -1))

    def entries(row: Column) -> Column:
        spans, gaps = row["spans"], row["gaps"]
        marked = F.array_join(
            F.transform(gaps, lambda gap, i: F.when(i < F.size(spans), F.concat(gap, F.lit(OPEN), i.cast("string"), F.lit(CLOSE))).otherwise(gap)), ""
        )
        parts = F.filter(F.transform(F.split(marked, f"[{delimiters}]", -1), _trim), lambda x: x != "")
        return F.transform(F.array(F.struct(spans.alias("spans"), F.transform(spans, _unquote).alias("inside"), parts.alias("parts"))), named)

    def named(row: Column) -> Column:
        spans, inside = row["spans"], row["inside"]

        def restored(x: Column) -> Column:
            """Placeholders put back; most texts have none, or are one as a whole."""
            at = F.when(F.startswith(x, F.lit(OPEN)) & F.endswith(x, F.lit(CLOSE)), F.substring(x, F.lit(2), F.length(x) - 2).try_cast("int"))
            back = F.aggregate(
                F.regexp_extract_all(x, F.lit(f"{OPEN}(\\d+){CLOSE}"), F.lit(1)),
                x,
                lambda acc, i: F.replace(acc, F.concat(F.lit(OPEN), i, F.lit(CLOSE)), F.get(spans, i.cast("int"))),
            )
            literal = lambda y: F.replace(y, F.lit(f"{OPEN}{LITERAL}{CLOSE}"), F.lit(OPEN))
            return F.when(F.instr(x, OPEN) == 0, x).otherwise(literal(F.coalesce(F.get(inside, at), back)))

        # name, then what follows it, each bound before it is used again
        heads = F.transform(row["parts"], lambda x: F.struct(F.regexp_extract(x, r"(?s)^([^\s=]+)", 1).alias("n"), x.alias("x")))
        rests = F.transform(heads, lambda p: F.struct(p["n"].alias("n"), _ltrim(F.substring(p["x"], F.length(p["n"]) + 1, F.length(p["x"]))).alias("r")))
        values = F.transform(rests, lambda p: F.struct(p["n"].alias("n"), F.when(F.startswith(p["r"], F.lit("=")), _ltrim(F.substring(p["r"], F.lit(2), F.length(p["r"])))).otherwise(p["r"]).alias("v")))
        return F.transform(values, lambda p: F.struct(cased(restored(p["n"])).alias("name"), restored(p["v"]).alias("value")))

    # the struct is bound once through a one-element array, so the patterns run once a row
    once = F.transform(F.array(F.struct(spans.alias("spans"), gaps.alias("gaps"))), lambda row: F.get(entries(row), F.lit(0)))
    return F.filter(F.get(once, F.lit(0)), lambda e: e["name"] != "")


def first_values(text: Column, names: Sequence[str]) -> Column:
    """Struct of the first value of each name (in lower case) in a packed field, null where there is none."""

    def named(name: str):
        return lambda e: e["name"] == name

    pick = lambda es: F.struct(*[F.get(F.filter(es, named(n)), F.lit(0))["value"].alias(n) for n in names])
    return F.get(F.transform(F.array(packed_entries(text)), pick), F.lit(0))


def explode_packed(
    df: DataFrame,
    column: str,
    keep: Sequence[str],
    list_names: Sequence[str] = (),
    delimiters: str = ";|",
    quotes: str = "\"'",
    member: str = MEMBER,
) -> DataFrame:
    """One row per value of a packed field: ``keep`` columns, pos (from 1), attr_name, attr_value.

    Entries of ``list_names`` may hold several members; each member gets a row and a
    position of its own. A list entry without any member keeps one row with its
    value as it is. Null, empty and blank fields give no row. Repeated input rows
    give repeated output rows. Other columns of ``df`` are not looked at, whatever
    their names.
    """
    entries = packed_entries(F.col(f"`{column}`"), delimiters, quotes)
    if list_names:
        names = [n.lower() for n in list_names]

        def members(e: Column) -> Column:
            found = F.regexp_extract_all(e["value"], F.lit(member), F.lit(0))
            many = F.transform(found, lambda m: F.struct(e["name"].alias("name"), m.alias("value")))
            return F.when(e["name"].isin(names) & (F.size(found) > 0), many).otherwise(F.array(e))

        entries = F.flatten(F.transform(entries, members))
    kept = [F.col(f"`{c}`") for c in keep]
    out = df.select(*kept, F.posexplode(entries).alias("__pos", "__entry"))
    return out.select(*kept, (F.col("__pos") + 1).alias("pos"), F.col("__entry.name").alias("attr_name"), F.col("__entry.value").alias("attr_value"))
