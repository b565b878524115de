"""Fill-in-the-middle: whole texts cut at two places between units and put in another order, with markers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType, arrow_udf

MARKERS = ("<P>", "<S>", "<M>")
CODE_POINT = r"(?s:.)"
#: A match keeps about 100 bytes for every unit. Longer texts are matched in stretches of so many units, from where the
#: last one ended; this bounds the memory of a task and leaves the same units.
STRETCH = 1_000_000


def unit_ends(unit: str, stretch: int = STRETCH) -> Callable[[str], list[int] | None]:
    """The ends of a text's units, from left to right; None if they do not fill the text.

    One full match of the repeated unit keeps the place of every repetition.
    """
    whole = regex.compile(f"({unit})*")
    part = regex.compile(f"({unit}){{1,{stretch}}}")

    def ends(text: str) -> list[int] | None:
        if len(text) <= stretch:
            match = whole.fullmatch(text)
            return match.ends(1) if match else None
        found: list[int] = []
        while not found or found[-1] < len(text):
            match = part.match(text, found[-1] if found else 0)
            if match is None or match.end() == match.start():
                return None
            found += match.ends(1)
        return found

    return ends


def _cuts(unit: str, stretch: int) -> Callable[..., Column]:
    @arrow_udf("n long, first long, second long", ArrowUDFType.SCALAR_ITER)
    def cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        ends_of = unit_ends(unit, stretch)
        for texts, one, two in batches:
            rows = []
            for text, a, b in zip(texts, one.to_pylist(), two.to_pylist(), strict=True):
                ends = ends_of(text.as_py())
                if ends is None:
                    rows.append({"n": None, "first": None, "second": None})
                    continue
                n = len(ends)
                a, b = sorted((a % (n + 1), b % (n + 1)))
                rows.append({"n": n, "first": ends[a - 1] if a else 0, "second": ends[b - 1] if b else 0})
            kind = pa.struct([("n", pa.int64()), ("first", pa.int64()), ("second", pa.int64())])
            yield pa.array(rows, kind)

    return cuts


def _drawn(key: Column, group: int) -> Column:
    """The group-th eight hexadecimal digits of a hash, as a number."""
    return F.conv(F.substring(key, 8 * group + 1, 8), 16, 10).cast("long")


def _check_markers(markers: tuple[str, str, str]) -> None:
    """A marker's first sign is in no other place of any marker, so no marker begins inside a text that has none."""
    if len(set(markers)) < 3 or not all(markers):
        raise ValueError("three different markers are needed")
    if any(first in other[1:] for first in {m[0] for m in markers} for other in markers):
        raise ValueError("a marker's first sign must not be in the rest of a marker")


def rearrange(
    docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, unit: str = CODE_POINT,
    markers: tuple[str, str, str] = MARKERS, id: str = "doc_id", text: str = "text", stretch: int = STRETCH,
) -> DataFrame:
    """``doc_id, text, n, form, prefix_chars, middle_chars, output``: each text cut into prefix, middle and suffix.

    ``n`` counts the units of the whole text. Both cuts lie after a number of units drawn from a hash of ``seed`` and
    the id: equal ids give equal draws, whatever the partitions; rows with one id are drawn alike, each on its own text.
    ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``. Plain is the text
    itself: for ``plain_percent`` of the ids, for empty texts, for texts that hold a marker, and for texts that the
    units do not fill (their ``n`` is null; it cannot happen with code points). A null text is an empty one; a null id is hashed as
    an empty string. Other columns are left behind, so their names do not matter. No row meets another: there is no
    shuffle, and a lost executor costs its own rows.
    """
    _check_markers(markers)
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.sha2(F.concat_ws("", F.lit(f"{seed}:"), F.col(id).cast("string")), 256)
    rows = docs.select(F.col(id).alias("doc_id"), body.alias("text"), key.alias("_key"))
    rows = rows.withColumn("_cut", _cuts(unit, stretch)("text", _drawn(F.col("_key"), 0), _drawn(F.col("_key"), 1)))
    held = F.lit(False)
    for marker in markers:
        held = held | F.contains("text", F.lit(marker))
    plain = (F.col("text") == "") | held | F.col("_cut.n").isNull() | (_drawn(F.col("_key"), 2) % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(_drawn(F.col("_key"), 3) % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.withColumn("form", form)
    first, second = F.col("_cut.first").cast("int"), F.col("_cut.second").cast("int")
    prefix = F.substring("text", F.lit(1), first)
    middle = F.substring("text", first + 1, second - first)
    suffix = F.substring("text", second + 1, F.length("text"))
    p, s, m = map(F.lit, markers)
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
    )
    shown = F.col("form") != "plain"
    return rows.select(
        "doc_id", "text", F.col("_cut.n").alias("n"), "form", F.when(shown, first.cast("long")).alias("prefix_chars"),
        F.when(shown, (second - first).cast("long")).alias("middle_chars"), output.alias("output"),
    )


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The exact text again, from a rearranged text and its form alone."""
    _check_markers(markers)
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in markers), -1)
    after = lambda i: F.get(parts, F.lit(i))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(after(1), after(3), after(2)))
        .otherwise(F.concat(after(2), after(3), after(1)))
    )
