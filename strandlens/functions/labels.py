"""Scalar clean-up of labels, dates, flags, numbers and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats tried in this order; text that fits none stays as it is.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "M/d/yyyy", "M/d/yy", "yyyy-MM-dd HH:mm:ss")
TRUE_WORDS = ("true", "yes", "y", "1")
NUMBER = r"^[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def filled(c: Column) -> Column:
    """True where there is text other than blanks."""
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def date_text(c: Column) -> Column:
    """ISO text of a date in one of the known formats; anything else unchanged."""
    text = F.trim(c.cast("string"))
    shape = {
        "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
        "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$",
        "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
        "M/d/yy": r"^\d{1,2}/\d{1,2}/\d{2}$",
        "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    }
    tried = [F.when(text.rlike(shape[f]), F.date_format(F.try_to_timestamp(text, F.lit(f)), "yyyy-MM-dd")) for f in DATE_FORMATS]
    return F.coalesce(*tried, c.cast("string"))


def label_text(c: Column) -> Column:
    """Trimmed text; numbers read as floating point lose their fraction."""
    text = F.trim(c.cast("string"))
    return F.regexp_replace(text, r"^(-?[0-9]+)\.0+$", "$1")


def flag(c: Column) -> Column:
    """True for true, yes, y and 1 in any case and for numbers other than 0; all else, null too, is false."""
    text = F.lower(F.trim(c.cast("string")))
    number = F.when(text.rlike(r"^-?[0-9.]+$"), text.try_cast("double") != 0)
    return F.coalesce(text.isin(*TRUE_WORDS), F.lit(False)) | F.coalesce(number, F.lit(False))


def number(c: Column, default: float | None = None) -> Column:
    """The number in a text, else the default; NaN counts as missing."""
    value = c.cast("string").try_cast("double")
    value = F.when(~F.isnan(value), value)
    return value if default is None else F.coalesce(value, F.lit(default))


def input_amount(c: Column) -> Column:
    """An input amount: commas dropped, 'inf' in any case allowed, anything else that isn't a number raises; blank is null."""
    text = F.lower(F.regexp_replace(F.trim(c.cast("string")), ",", ""))
    return (
        F.when(~filled(c), F.lit(None).cast("double"))
        .when(text == "inf", F.lit(float("inf")))
        .when(text.rlike(NUMBER), text.try_cast("double"))
        .otherwise(F.raise_error(F.concat(F.lit("not an input amount: "), c.cast("string"))).cast("double"))
    )


def joined_id(*parts: Column) -> Column:
    """The parts joined by '::'; a missing or blank part raises, since concat_ws would pass over it."""
    whole = F.concat_ws("::", *(p.cast("string") for p in parts))
    good = filled(parts[0])
    for p in parts[1:]:
        good = good & filled(p)
    return F.when(good, whole).otherwise(F.raise_error(F.concat(F.lit("id with a missing part: "), whole)))


def base_name(c: Column) -> Column:
    """A parent's name without the suffix that begins at the first underscore."""
    return F.regexp_replace(c, "_.*$", "")


def index_key(p5: Column, p7: Column, dual: bool) -> Column:
    """P5, or P5_P7 where the run is dual-indexed and P7 is filled."""
    return F.when(filled(p7), F.concat_ws("_", p5, p7)).otherwise(p5) if dual else p5


def legacy_distance(c: Column) -> Column:
    """Old distance notes: a leading '1-' or trailing '-1' goes, then a leading 'Unique'; 'NA-NA' is null."""
    text = F.regexp_replace(F.regexp_replace(c, r"^(1-)|(-1)$", ""), "^(Unique)", "")
    return F.nullif(text, F.lit("NA-NA"))


#: A misspelt stock name and its correction.
MISSPELT = ("SIVmac293M2", "SIVmac239M2")


def fixed_name(c: Column) -> Column:
    return F.replace(c, F.lit(MISSPELT[0]), F.lit(MISSPELT[1]))


def output_stem(c: Column) -> Column:
    """A file name without a sequence file's ending, in any case."""
    return F.regexp_replace(c, r"(?i)\.(fastq|fq)(\.gz)?$", "")


def shown_flag(c: Column) -> Column:
    return F.when(c, F.lit("Yes")).otherwise(F.lit(""))


def shown_number(c: Column) -> Column:
    """Three significant digits without trailing zeros; blank for null.  Meant for shares, 0 to 1."""
    places = F.when(c == 0, F.lit(0)).otherwise(F.lit(2) - F.floor(F.log10(F.abs(c))).cast("int"))
    texts = [F.when(places <= k, F.format_string(f"%.{k}f", c)) for k in range(12)]
    whole = F.coalesce(*texts, F.lit("0"))
    return F.when(c.isNull(), F.lit("")).otherwise(F.regexp_replace(F.regexp_replace(whole, r"(\.\d*?)0+$", "$1"), r"\.$", ""))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0 or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
