"""Chinese resident ID-card checks and derived fields as native columns.

Everything here is a pure column expression (no UDF), so the whole enrichment
runs inside whole-stage codegen and scales with the number of executors.
Date parsing follows the lenient JVM calendar: an out-of-range month or day
rolls over into the next month/year instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import jtrim
from .time import TIME_FORMAT

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
# Weight of each of the first 17 digits of an 18-digit number.
POWER_WEIGHTS = [7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2]
# Check character for (weighted sum mod 11) = 0, 1, 2, ..., 10.
CHECK_CODES = ["1", "0", "x", "9", "8", "7", "6", "5", "4", "3", "2"]
# Province code -> name, in code order.
PROVINCES = [
    ("11", "北京"), ("12", "天津"), ("13", "河北"), ("14", "山西"), ("15", "内蒙古"),
    ("21", "辽宁"), ("22", "吉林"), ("23", "黑龙江"),
    ("31", "上海"), ("32", "江苏"), ("33", "浙江"), ("34", "安徽"), ("35", "福建"),
    ("36", "江西"), ("37", "山东"),
    ("41", "河南"), ("42", "湖北"), ("43", "湖南"), ("44", "广东"), ("45", "广西"),
    ("46", "海南"),
    ("50", "重庆"), ("51", "四川"), ("52", "贵州"), ("53", "云南"), ("54", "西藏"),
    ("61", "陕西"), ("62", "甘肃"), ("63", "青海"), ("64", "宁夏"), ("65", "新疆"),
    ("71", "台湾"), ("81", "香港"), ("82", "澳门"), ("91", "国外"),
]
# Shape patterns, kept as written (their classes also accept a literal '|').
FORMAT_ANY = r"(^\d{15}$)|(\d{17}(?:\d|x|X)$)"
FORMAT_15 = r"^[1-9]\d{7}((0\d)|(1[0-2]))(([0|1|2]\d)|3[0-1])\d{3}$"
FORMAT_18 = r"^[1-9]\d{5}[1-9]\d{3}((0\d)|(1[0-2]))(([0|1|2]\d)|3[0-1])\d{3}([\d|x|X]{1})$"
# Two-digit years resolve into the 100-year window starting this many months
# before "now" (the JVM's default century start is now - 80 years).
CENTURY_START_MONTHS = 80 * 12
# ---------------------------------------------------------------------------

_CHECK_STRING = "".join(CHECK_CODES)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole_match(pattern: str) -> str:
    """A regex that must match the whole string (JVM ``String.matches``)."""
    return f"^(?:{pattern})\\z"


def is_digits(s: Column | str) -> Column:
    """Non-empty and ASCII digits only; false for null."""
    s = _col(s)
    return F.coalesce(s.rlike(r"^[0-9]+\z"), F.lit(False))


def power_sum(s17: Column | str) -> Column:
    """Weighted digit sum of a 17-digit string; 0 when the length is not 17.

    The string is referenced once (digits zipped with the weights, then
    summed), so the expression stays small however often it is inlined.
    """
    s17 = _col(s17)
    weights = F.array(*[F.lit(w) for w in POWER_WEIGHTS])
    products = F.zip_with(F.split(s17, ""), weights, lambda d, w: d.try_cast("int") * w)
    total = F.aggregate(products, F.lit(0), lambda acc, x: acc + x)
    return F.when(F.length(s17) == 17, total).otherwise(F.lit(0))


def check_code(total: Column | str) -> Column:
    """Check character for a weighted sum (lower-case ``x``)."""
    return F.substring(F.lit(_CHECK_STRING), (F.pmod(_col(total), F.lit(11)) + 1).try_cast("int"), 1)


def valid_18(s: Column | str) -> Column:
    """18 chars, 17 digits, last char equals the check code ignoring case.

    No province or date check. False for null.
    """
    s = _col(s)
    head = F.substring(s, 1, 17)
    ok = (F.length(s) == 18) & is_digits(head)
    return F.coalesce(
        F.when(ok, F.lower(F.substring(s, 18, 1)) == check_code(power_sum(head))),
        F.lit(False))


def _century_start(as_of: str) -> Column:
    return F.add_months(F.to_timestamp(F.lit(as_of)), -CENTURY_START_MONTHS)


def lenient_date(year: Column, month: Column, day: Column) -> Column:
    """``year-month-day`` where month and day may overflow (lenient calendar)."""
    base = F.make_date(year, F.lit(1), F.lit(1))
    return F.date_add(F.add_months(base, month - 1), day - 1)


def two_digit_year_date(yy: Column, mm: Column, dd: Column, as_of: str) -> Column:
    """Lenient ``yyMMdd`` date with the JVM two-digit-year window.

    The year lands in [as_of - 80y, as_of + 20y). Only when the two digits
    equal the window start's own two digits the full date decides the
    century, exactly as the JVM does.
    """
    start = _century_start(as_of)
    start_year = F.year(start)
    start_yy = F.pmod(start_year, F.lit(100))
    century = start_year - start_yy
    plain = lenient_date(century + yy + F.when(yy < start_yy, 100).otherwise(0), mm, dd)
    same = lenient_date(century + yy, mm, dd)
    return (F.when(yy != start_yy, plain)
            .when(same.cast("timestamp") < start, lenient_date(century + yy + 100, mm, dd))
            .otherwise(same))


def with_converted_15(df: DataFrame, src: str, out: str, as_of: str) -> DataFrame:
    """Add ``out``: the 15-digit number in ``src`` as 18 digits (else null).

    Staged in three projections so the date logic is computed once and the
    checksum reads a plain column (Catalyst keeps non-cheap expressions that
    are used many times in their own projection).
    """
    s = F.col(src)
    ok = (F.length(s) == 15) & is_digits(s)
    yy = F.substring(s, 7, 2).try_cast("int")
    mm = F.substring(s, 9, 2).try_cast("int")
    dd = F.substring(s, 11, 2).try_cast("int")
    d = df.withColumn("__y15", F.when(ok, F.year(two_digit_year_date(yy, mm, dd, as_of))))
    d = d.withColumn("__h17", F.when(ok, F.concat(F.substring(s, 1, 6),
                                                  F.lpad(F.col("__y15").cast("string"), 4, "0"),
                                                  F.substring(s, 9, 7))))
    d = d.withColumn(out, F.when(ok, F.concat(F.col("__h17"), check_code(power_sum("__h17")))))
    return d.drop("__y15", "__h17")


def valid_any(s: Column | str, as_of: str) -> Column:
    """15 digits (always convertible) or a valid 18-char number."""
    s = _col(s)
    fifteen = (F.length(s) == 15) & is_digits(s)
    return F.coalesce(fifteen, F.lit(False)) | valid_18(s)


def with_valid_15_strict(df: DataFrame, src: str, out: str, as_of: str) -> DataFrame:
    """Add ``out``: strict 15-digit check (province, not in the future,
    two-digit year rule, real calendar day). Uncalled by the jobs; offered as
    a data-quality column."""
    s = F.col(src)
    ok = (F.length(s) == 15) & is_digits(s)
    yy = F.substring(s, 7, 2).try_cast("int")
    mm = F.substring(s, 9, 2).try_cast("int")
    dd = F.substring(s, 11, 2).try_cast("int")
    d = df.withColumn("__birth", F.when(ok, two_digit_year_date(yy, mm, dd, as_of)))
    birth = F.col("__birth")
    now_ts = F.to_timestamp(F.lit(as_of))
    now_yy = F.pmod(F.year(now_ts), F.lit(100))
    province_ok = F.substring(s, 1, 2).isin([code for code, _ in PROVINCES])
    y = F.year(birth)
    is_leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    max_day = (F.when(mm.isin(1, 3, 5, 7, 8, 10, 12), 31)
               .when(mm.isin(4, 6, 9, 11), 30)
               .when(is_leap, 29).otherwise(28))
    rest = (province_ok
            & ~(birth.cast("timestamp") > now_ts)
            & ~((yy < 50) & (yy > now_yy))
            & mm.between(1, 12)
            & (dd >= 1) & (dd <= max_day))
    return d.withColumn(out, F.coalesce(F.when(ok, rest), F.lit(False))).drop("__birth")


def format_any(s: Column | str) -> Column:
    s = _col(s)
    return F.coalesce(F.when(s != "", s.rlike(_whole_match(FORMAT_ANY))), F.lit(False))


def format_15(s: Column | str) -> Column:
    s = _col(s)
    return F.coalesce(F.when(s != "", s.rlike(_whole_match(FORMAT_15))), F.lit(False))


def format_18(s: Column | str) -> Column:
    """No null guard in the reference: null in, null out."""
    return _col(s).rlike(_whole_match(FORMAT_18))


def province_map() -> Column:
    """Literal code -> name map; tiny and fixed, so no join is needed."""
    return F.create_map(*[F.lit(x) for pair in PROVINCES for x in pair])


def province_name(code: Column | str) -> Column:
    """Name for a two-digit code; unknown -> ''."""
    return F.coalesce(F.try_element_at(province_map(), _col(code)), F.lit(""))


def gender_of(id18: Column | str) -> Column:
    """17th digit odd -> 1, even -> 2."""
    d = F.substring(_col(id18), 17, 1).try_cast("int")
    return F.when(d % 2 != 0, 1).otherwise(2)


def birthday_of(id18: Column | str) -> Column:
    """Chars 7-14 read leniently as yyyyMMdd, rendered ``yyyy-MM-dd 00:00:00``."""
    id18 = _col(id18)
    y = F.substring(id18, 7, 4).try_cast("int")
    m = F.substring(id18, 11, 2).try_cast("int")
    d = F.substring(id18, 13, 2).try_cast("int")
    return F.when(y >= 1, F.date_format(lenient_date(y, m, d).cast("timestamp"), TIME_FORMAT))


def with_enriched_idcard(df: DataFrame, as_of: str, col: str = "idcard",
                         valid_only: bool = False) -> DataFrame:
    """Replace ``col`` by the enrichment fields ``idcard, gender,
    birth_province, birthday``.

    Invalid (or null) numbers give gender -1 and empty strings; the emitted
    ``idcard`` is the original text (untrimmed, 15 digits stay 15), or ''
    when invalid. ``valid_only`` keeps only rows that would have a non-empty
    idcard and birthday, deciding before the derived fields are computed:
    a filter on the derived columns themselves would be pushed below the
    staged projections and re-inline all of them.
    """
    d = df.withColumn("__t", jtrim(F.col(col)))
    d = with_converted_15(d, "__t", "__c15", as_of)
    t = F.col("__t")
    d = d.withColumn("__ok", F.coalesce(valid_any(t, as_of), F.lit(False)))
    if valid_only:
        # Valid numbers always get a non-empty idcard and birthday, except an
        # 18-digit number with birth year 0000 (no such calendar year).
        from ..operators.filters import filter_valid_idcards
        year_ok = F.when(F.length(t) == 18, F.substring(t, 7, 4).try_cast("int") >= 1).otherwise(True)
        d = filter_valid_idcards(d, F.when(F.col("__ok"), t), F.when(year_ok, t))
    d = d.withColumn("__id18", F.when(F.length(t) == 15, F.col("__c15")).otherwise(t))
    ok, id18 = F.col("__ok"), F.col("__id18")
    fields = {
        "idcard": F.when(ok, F.col(col)).otherwise(F.lit("")),
        "gender": F.when(ok, gender_of(id18)).otherwise(F.lit(-1)).cast("int"),
        "birth_province": F.when(ok, province_name(F.substring(id18, 1, 2))).otherwise(F.lit("")),
        "birthday": F.when(ok, F.coalesce(birthday_of(id18), F.lit(""))).otherwise(F.lit("")),
    }
    keep = [c for c in df.columns if c != col]
    return d.select(*keep, *[c.alias(n) for n, c in fields.items()])


def calendar_date_ok(s: Column | str, as_of: str) -> Column:
    """Whether the number's month and day are those of a calendar date, in both lengths."""
    t = jtrim(_col(s))
    old = F.length(t) == 15
    yy, mm, dd = (F.substring(t, p, 2).try_cast("int") for p in (7, 9, 11))
    year = F.year(two_digit_year_date(yy, F.lit(1), F.lit(1), as_of))
    y = F.when(old, year).otherwise(F.substring(t, 7, 4).try_cast("int"))
    m = F.when(old, mm).otherwise(F.substring(t, 11, 2).try_cast("int"))
    d = F.when(old, dd).otherwise(F.substring(t, 13, 2).try_cast("int"))
    text = F.format_string("%04d-%02d-%02d", y, m, d)
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False))
