"""Source scans of the jobs.

Every scan takes ``src``: a DataFrame, a parquet path (a directory that may be
partitioned by ``p_day``) or a catalog table name. Filters are plain column
predicates so Catalyst pushes them into the scan: ``p_day`` bounds become
partition filters, the rest parquet ``PushedFilters`` or JDBC ``WHERE``
clauses; the selected columns become the ``ReadSchema``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import days_before
from ..operators.filters import filter_day_range

# The columns of the sources.
LOG_COLUMNS = ["uid", "deviceid", "plateform", "eventid", "eventcontent", "begintime", "uploadtime",
               "ip", "version", "pmenu", "menu", "net", "channel", "client", "os", "subplateform",
               "p_day"]
FOOTPRINT_COLUMNS = ["uid", "deviceid", "channel", "version", "plateform", "begintime"]
ORDER_COLUMNS = ["uuid", "uid", "schemeid", "issueno", "lotteryid", "playtypeid", "superplaytypeid",
                 "betnumber", "hteamid", "hteam", "vteamid", "vteam", "tournamentid",
                 "tournamentname", "matchresult", "iswin", "datetime", "platformcode", "multiple",
                 "bunch", "betsp", "winsp", "money", "p_day"]
DEVICE_COLUMNS = ["uid", "registerday", "deviceid", "registertime", "registerplateform", "channel",
                  "version"]
REGISTRATION_FIELDS = ["uid", "username", "registerdate", "channel", "phone_os", "platform",
                       "app_version", "phone_name"]


def load(spark: SparkSession, src) -> DataFrame:
    """DataFrame as is; a path is read as parquet; anything else is a table.

    The number of tasks is that of the splits left after the filters, set by
    ``spark.sql.files.maxPartitionBytes``.
    """
    if isinstance(src, DataFrame):
        return src
    if "/" in src or src.endswith(".parquet"):
        return spark.read.parquet(src)
    return spark.table(src)


def day_col(name: str = "p_day"):
    """A ``yyyy-MM-dd`` day column as text, whether the folders were read as
    STRING or inferred as DATE (partition filters still prune either way)."""
    return F.col(name).cast("string")


def _with_text_day(df: DataFrame, cols: list[str], name: str = "p_day") -> DataFrame:
    return df.select(*[day_col(c).alias(c) if c == name else F.col(c) for c in cols])


def scan_logs_by_day(spark: SparkSession, src, start_day: str, end_day: str) -> DataFrame:
    """Behaviour logs with ``start_day <= p_day <= end_day`` (string compare)."""
    df = load(spark, src)
    return _with_text_day(filter_day_range(df, start_day, end_day), LOG_COLUMNS)


def scan_footprint_logs(spark: SparkSession, src, start_day: str, end_day: str) -> DataFrame:
    """The six track columns of identified rows in the day range.

    ``deviceid != ''`` is compared untrimmed, as the reference does.
    """
    df = load(spark, src)
    cond = (F.col("uid") > 0) & F.col("deviceid").isNotNull() & (F.col("deviceid") != "")
    return filter_day_range(df, start_day, end_day).where(cond).select(*FOOTPRINT_COLUMNS)


def scan_recent_orders(spark: SparkSession, src, as_of: str, days: int = 2) -> DataFrame:
    """Orders with ``p_day >= as_of - days``."""
    df = load(spark, src)
    return _with_text_day(df.where(day_col() >= days_before(as_of, days)), ORDER_COLUMNS)


def scan_recent_devices(spark: SparkSession, src, as_of: str, days: int = 7) -> DataFrame:
    """Devices with ``registerday >= as_of - days``."""
    df = load(spark, src)
    return _with_text_day(df.where(day_col("registerday") >= days_before(as_of, days)), DEVICE_COLUMNS,
                          "registerday")


def scan_existing_keys(spark: SparkSession, target, since_day: str, key: str = "_id") -> DataFrame:
    """Keys of target documents with ``p_day >= since_day``; only the key is read."""
    df = load(spark, target)
    return df.where(day_col() >= F.lit(since_day)).select(F.col(key).alias("uuid"))


def scan_registration_text(spark: SparkSession, path_or_lines) -> DataFrame:
    """``#``-separated lines split into the 8 named string fields plus ``value``.

    Trailing empty fields are kept; missing fields are null (``get`` never
    raises past the end); extra fields are ignored. The CSV reader is not
    used: quotes must stay literal.
    """
    lines = path_or_lines if isinstance(path_or_lines, DataFrame) else spark.read.text(path_or_lines)
    parts = F.split(F.col("value"), "#", -1)
    return lines.select(
        "value", F.size(parts).alias("n_fields"),
        *[F.get(parts, i).alias(name) for i, name in enumerate(REGISTRATION_FIELDS)])


# Parallel reads and rows per round trip of a JDBC scan.
JDBC_PARTITIONS = 8
JDBC_FETCH_ROWS = 10_000
# Our names -> the database's; callers with another schema pass their own.
USER_COLUMNS = {"uid": "n_user_id", "username": "s_login_name", "registerdate": "d_register_time",
                "registerplateform": "s_platform_code", "app_version": "s_app_version",
                "channel": "s_entrance_code", "phone_os": "s_platform_version", "phone_name": "s_phone_name"}
IDCARD_COLUMNS = {"uid": "n_user_id", "idcard": "s_idcard_number"}


def _jdbc(spark: SparkSession, url: str, query: str, options: dict | None, predicates: list[str] | None = None) -> DataFrame:
    if predicates:
        properties = {"fetchsize": str(JDBC_FETCH_ROWS), **{k: str(v) for k, v in (options or {}).items()}}
        return spark.read.jdbc(url, f"({query}) t", predicates=predicates, properties=properties)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) t").option("fetchsize", JDBC_FETCH_ROWS)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


# Cells that a range with too many rows is cut into, and how often at most.
DEPTH_CELLS, DEPTH_ROUNDS = 256, 8


def equal_ranges(spark: SparkSession, url: str, table: str, column: str, where: str, options: dict | None, parts: int) -> list[int]:
    """Upper ends of all but the last of ``parts`` ranges of an integer column with about equally many rows.

    The database counts the rows of even cells; cells with more than a quarter of a range's rows are cut
    again, all in one grouped count a round, until none is left or they are single values. At most 4 * parts
    cells are cut in a round, so each count returns at most 4 * parts * DEPTH_CELLS rows.
    """
    edge = _jdbc(spark, url, f"select min({column}) as lo, max({column}) as hi, count(*) as n from {table} where {where}", options).first()
    if edge[0] is None:
        return []
    total = int(edge[2])
    cells, heavy = [], [(int(edge[0]), int(edge[1]), total)]
    for _ in range(DEPTH_ROUNDS):
        heavy, done = [c for c in heavy if c[0] < c[1] and 4 * parts * c[2] > total], [c for c in heavy if c[0] == c[1] or 4 * parts * c[2] <= total]
        cells += done
        if not heavy:
            break
        width = [(hi - lo) // DEPTH_CELLS + 1 for lo, hi, _ in heavy]
        cases = " ".join(f"when {column} between {lo} and {hi} then {k * DEPTH_CELLS} + ({column} - {lo} - mod({column} - {lo}, {w})) / {w}"
                         for k, ((lo, hi, _), w) in enumerate(zip(heavy, width)))
        inside = " or ".join(f"{column} between {lo} and {hi}" for lo, hi, _ in heavy)
        counts = _jdbc(spark, url, f"select cell, count(*) as n from (select case {cases} end as cell from {table} where {where} and ({inside})) c group by cell", options).collect()
        cut = []
        for cell, n in ((int(r[0]), int(r[1])) for r in counts):
            (lo, hi, _), w = heavy[cell // DEPTH_CELLS], width[cell // DEPTH_CELLS]
            first = lo + cell % DEPTH_CELLS * w
            cut.append((first, min(first + w - 1, hi), n))
        heavy = cut
    ends, seen = [], 0
    for _, hi, n in sorted(cells + heavy):
        seen += n
        while len(ends) < parts - 1 and seen * parts >= total * (len(ends) + 1):
            ends.append(hi)
    return ends


def _jdbc_split(spark: SparkSession, url: str, table: str, columns: dict[str, str], where: str, options: dict | None,
                bounds: tuple[int, int] | None, num_partitions: int) -> DataFrame:
    """A read split into ranges of uid: even ones between given bounds, else ranges of about equally many rows."""
    names = ", ".join(f"{theirs} as {ours}" for ours, theirs in columns.items())
    query = f"select {names} from {table} where {where}"
    if num_partitions > 1 and bounds is not None:
        return _jdbc(spark, url, query, {**(options or {}), "partitionColumn": "uid", "lowerBound": str(bounds[0]),
                                         "upperBound": str(max(bounds[1], bounds[0]) + 1), "numPartitions": str(num_partitions)})
    ends = equal_ranges(spark, url, table, columns["uid"], where, options, num_partitions) if num_partitions > 1 else []
    if not ends:
        return _jdbc(spark, url, query, options)
    inner = [f"uid > {a} and uid <= {b}" for a, b in zip(ends, ends[1:])]
    return _jdbc(spark, url, query, options, [f"uid <= {ends[0]}", *inner, f"uid > {ends[-1]}"])


def scan_users_incremental(spark: SparkSession, url: str, table: str, max_uid: int, cutoff: str,
                           options: dict | None = None, columns: dict[str, str] | None = None,
                           num_partitions: int = JDBC_PARTITIONS) -> DataFrame:
    """New users from the user database: ``uid > max_uid`` registered before ``cutoff``.

    Column names are mapped inside the derived table; the predicates run in
    the database, and the read is split into uid ranges. Connection settings
    (``user``, ``password``, ``driver`` …) come from the caller.
    """
    c = {**USER_COLUMNS, **(columns or {})}
    where = f"{c['uid']} > {int(max_uid)} and {c['registerdate']} < '{cutoff}'"
    return _jdbc_split(spark, url, table, c, where, options, None, num_partitions)


def scan_idcards_jdbc(spark: SparkSession, url: str, table: str, min_uid: int,
                      lower_bound: int | None = None, upper_bound: int | None = None,
                      num_partitions: int = JDBC_PARTITIONS, options: dict | None = None,
                      columns: dict[str, str] | None = None) -> DataFrame:
    """``(uid, idcard)`` with ``uid > min_uid and idcard is not null``, split into uid ranges."""
    c = {**IDCARD_COLUMNS, **(columns or {})}
    bounds = (lower_bound, upper_bound) if lower_bound is not None and upper_bound is not None else None
    return _jdbc_split(spark, url, table, c, f"{c['uid']} > {int(min_uid)} and {c['idcard']} is not null", options, bounds, num_partitions)


def scan_mapping_tables(spark: SparkSession, src: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three mapping relations ``mapper``, ``template``, ``detail``.

    ``src`` maps each name to a DataFrame, path or table; or holds ``url`` (and
    JDBC options) to read the database tables of the same names.
    """
    if "url" in src:
        opts = {k: v for k, v in src.items() if k not in ("url", "tables")}
        names = src.get("tables", {})

        def jdbc_table(name: str) -> DataFrame:
            reader = spark.read.format("jdbc").option("url", src["url"]).option("dbtable", names.get(name, name))
            for k, v in opts.items():
                reader = reader.option(k, v)
            return reader.load()
        mapper, template, detail = (jdbc_table(n) for n in ("mapper", "template", "detail"))
    else:
        mapper, template, detail = (load(spark, src[n]) for n in ("mapper", "template", "detail"))
    return (mapper.select("action_id", "template_id"), template.select("id"),
            detail.select("template_id", "attribute", "target_attribute", "datatype", "ps", "es_ps",
                          "plateform", "status"))
