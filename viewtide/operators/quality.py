"""Validation, typed records, and accounts of what was rejected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.functions import fields, lines
from viewtide.params import DOMAIN


def _others(table: DataFrame, *dropped: str) -> list[str]:
    return [name for name in table.columns if name not in dropped]


def _with_fields(raw: DataFrame) -> DataFrame:
    """Adds the array ``fields``, split exactly once per line.

    Written as a generator of one element: Catalyst copies a projected
    expression into every filter above it, and the rules use ``fields`` five
    times, but it does not look inside a generator.
    """
    return raw.select("*", F.explode(F.array(lines.line_fields(F.col("value")))).alias("fields"))


def parse_line(raw: DataFrame) -> DataFrame:
    """The four named fields as text, and how many fields the line has."""
    parts = F.col("fields")
    return _with_fields(raw).select(
        *_others(raw, "value"),
        lines.field(parts, 1).alias("domain_code"),
        lines.field(parts, 2).alias("page_title"),
        lines.field(parts, 3).alias("count_views"),
        lines.field(parts, 4).alias("total_response_size"),
        F.size(parts).alias("field_count"))


def filter_domain(raw: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """Lines of one domain code, exactly: ``en`` excludes ``en.m``."""
    return raw.filter(lines.in_domain(F.col("value"), domain))


def reject_hyphen_title(raw: DataFrame, domain: str = DOMAIN) -> DataFrame:
    return raw.filter(~lines.has_hyphen_title(F.col("value"), domain))


def reject_tab(raw: DataFrame) -> DataFrame:
    return raw.filter(~lines.has_tab(F.col("value")))


def reject_field_count(raw: DataFrame) -> DataFrame:
    return raw.filter(~lines.has_wrong_arity(lines.line_fields(F.col("value"))))


def reject_noninteger(raw: DataFrame) -> DataFrame:
    """Lines whose view count consists of ASCII digits; negatives go too."""
    return raw.filter(lines.is_digits(lines.field(lines.line_fields(F.col("value")), 3)))


def with_outcome(raw: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """Adds ``fields`` and ``reject_reason`` (null for a good line)."""
    return _with_fields(raw).withColumn(
        "reject_reason", lines.reject_reason(F.col("value"), F.col("fields"), domain))


def clean_lines(raw: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """Typed rows of the lines that pass every rule.

    The domain test runs on the unparsed line first; most lines of a mixed
    file stop there and are never split.
    """
    good = with_outcome(filter_domain(raw, domain), domain).filter("reject_reason IS NULL")
    parts = F.col("fields")
    name = F.col("file_name")
    return good.select(
        *_others(raw, "value"),
        fields.file_day(name).alias("day"),
        fields.file_hour(name).alias("hour_ts"),
        F.lit(domain).alias("domain_code"),
        lines.field(parts, 2).alias("page_title"),
        lines.field(parts, 3).cast("bigint").alias("views"))


def reject_counts(raw: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """Number of lines per outcome; kept lines count as ``kept``."""
    outcome = F.coalesce("reject_reason", F.lit("kept")).alias("outcome")
    return with_outcome(raw, domain).groupBy(outcome).agg(F.count("*").alias("lines"))


def reject_report(raw: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """The load counters as ``counter, lines``, in one pass.

    CONTAINS_QUOTES counts accepted titles with a double quote.
    """
    reason = F.col("reject_reason")
    quoted = F.contains(lines.field(F.col("fields"), 2), F.lit('"'))
    # Counter names.
    counters = {
        "GOOD": reason.isNull(),
        "BAD": reason.isNotNull(),
        "CONTAINS_TABS": reason == lines.TAB,
        "CONTAINS_QUOTES": reason.isNull() & quoted,
        "NONINTEGER_COUNT_OF_VIEWS": reason == lines.NONINTEGER,
    }
    totals = with_outcome(raw, domain).agg(
        *[F.count_if(test).alias(name) for name, test in counters.items()])
    return totals.unpivot([], list(counters), "counter", "lines")


def reject_rows(raw: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """Every reported reject with its file, position, raw line and reason."""
    return (with_outcome(raw, domain)
            .filter(~F.col("reject_reason").isin(*lines.SILENT_REASONS))
            .drop("fields"))


def outcome_metrics() -> list:
    """Aggregates over the lines of a domain that account for every one of them."""
    reason = F.col("reject_reason")
    return [F.count("*").alias("in_domain"), F.count_if(reason.isNull()).alias("kept"),
            *[F.count_if(reason == name).alias(name) for name in lines.REASONS
              if name != lines.DOMAIN_REASON]]


def daily_outcomes(judged: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """Daily views and reported rejects of judged lines in one aggregation.

    A good line counts under its day and page, a reported reject under its file, text
    and reason, so the text is read once for both. ``views`` is the sum of a page and
    null for rejects, ``copies`` is the number of lines. Silent rejects (other domains,
    the hyphen title) are only counted by ``outcome_metrics``.
    """
    reason, parts = F.col("reject_reason"), F.col("fields")
    good = reason.isNull()
    rows = judged.filter(good | ~reason.isin(*lines.SILENT_REASONS)).select(
        fields.file_day(F.col("file_name")).alias("day"),
        F.when(good, lines.field(parts, 2)).alias("page_title"), "reject_reason",
        F.when(~good, F.col("file_name")).alias("file_name"),
        F.when(~good, F.col("value")).alias("value"),
        F.when(good, lines.field(parts, 3).try_cast("bigint")).alias("views"))
    return rows.groupBy("day", "page_title", "reject_reason", "file_name", "value").agg(
        F.sum("views").alias("views"), F.count("*").alias("copies")).withColumn(
        "domain_code", F.lit(domain))


def with_record_outcome(raw: DataFrame) -> DataFrame:
    """Adds ``fields``, the parsed ``numbers`` and ``reject_reason`` of typed records
    (null for a record). Every number is parsed once, behind a generator like the fields."""
    parts = F.col("fields")
    parsed = _with_fields(raw).select(
        "*", F.explode(F.array(lines.record_numbers(parts))).alias("numbers"))
    return parsed.withColumn("reject_reason", lines.record_reject_reason(
        parts, F.col("numbers")))


def records_of(judged: DataFrame) -> DataFrame:
    """Typed records of the lines that were judged to be records."""
    name = F.col("file_name")
    parts = F.col("fields")
    stamp = F.struct(
        F.substring(name, 11, 4).cast("int").alias("year"),
        F.substring(name, 15, 2).cast("int").alias("month"),
        F.substring(name, 17, 2).cast("int").alias("day"),
        F.substring(name, 20, 2).cast("int").alias("hour"))
    return judged.filter("reject_reason IS NULL").select(
        *_others(judged, "value", "fields", "numbers", "reject_reason"),
        stamp.alias("hourly_timestamp"),
        lines.field(parts, 1).alias("domain_code"),
        lines.field(parts, 2).alias("page_title"),
        F.col("numbers.views").alias("count_views"),
        F.col("numbers.size").alias("total_response_size"))


def master_records(raw: DataFrame) -> DataFrame:
    """Typed records of all domains: four fields, whole numbers in the last two.

    The numbers are BIGINT; what does not fit 64 bits is a reject of its own.
    """
    return records_of(with_record_outcome(raw))


def master_reject_counts(raw: DataFrame) -> DataFrame:
    """Lines per outcome of the record store: ``stored`` or the reject reason."""
    outcome = F.coalesce("reject_reason", F.lit("stored")).alias("outcome")
    return with_record_outcome(raw).groupBy(outcome).agg(F.count("*").alias("lines"))


def record_metrics() -> list:
    """Aggregates over judged lines that account for every one of them."""
    reason = F.col("reject_reason")
    domain = lines.field(F.col("fields"), 1)
    counts = [F.count("*").alias("records"), F.count_if(reason.isNull()).alias("good_records"),
              *[F.count_if(reason == name).alias(name) for name in lines.RECORD_REASONS]]
    longest = F.min(F.when(~lines.has_wrong_arity(F.col("fields")), F.struct(
        (-F.length(domain)).alias("size"), domain.alias("domain_code"))))
    return [*counts, longest.alias("longest")]


def stamp_lines(raw: DataFrame) -> DataFrame:
    """Four-field lines prefixed with ``YYYYMMDDHH`` of their file."""
    stamped = F.concat(fields.hour_stamp(F.col("file_name")), F.col("value"))
    return reject_field_count(raw).withColumn("value", stamped)


def load_profile(raw: DataFrame) -> DataFrame:
    """Files, records, bad records, longest domain code and its least example.

    Counts are first summed per file and domain code, which reduces the lines
    to a small table inside the map tasks.
    """
    parts = F.col("fields")
    per_domain = (
        _with_fields(raw)
        .select("file_name", lines.has_wrong_arity(parts).alias("bad"),
                F.when(~lines.has_wrong_arity(parts), lines.field(parts, 1)).alias("domain_code"))
        .groupBy("file_name", "domain_code")
        .agg(F.count("*").alias("records"), F.count_if("bad").alias("bad_records")))
    longest = F.min(F.when(
        F.col("domain_code").isNotNull(),
        F.struct((-F.length("domain_code")).alias("size"), "domain_code")))
    return per_domain.groupBy("file_name").agg(
        F.sum("records").alias("records"), F.sum("bad_records").alias("bad_records"),
        longest.alias("longest")
    ).agg(
        F.count("*").alias("files"), F.sum("records").alias("records"),
        F.sum("bad_records").alias("bad_records"), F.min("longest").alias("longest")
    ).select("files", "records", "bad_records",
             (-F.col("longest.size")).alias("max_domain_length"),
             F.col("longest.domain_code").alias("max_domain_example"))


# Fields a round trip must preserve.
AUDITED = ("domain_code", "page_title", "count_views", "total_response_size")


def _paired(written: DataFrame, reread: DataFrame, key: list[str]) -> DataFrame:
    """Both sides joined on the key, with what differs."""
    left, right = written.alias("w"), reread.alias("r")
    joined = left.join(right, [F.col(f"w.{name}") == F.col(f"r.{name}") for name in key],
                       "full_outer")
    in_left = F.col("w.hourly_timestamp").isNotNull()
    in_right = F.col("r.hourly_timestamp").isNotNull()
    flags = [(~F.col(f"w.{name}").eqNullSafe(F.col(f"r.{name}"))).alias(f"{name}_changed")
             for name in AUDITED]
    return joined.select(
        *[F.coalesce(f"w.{name}", f"r.{name}").alias(name) for name in key],
        F.when(in_left & in_right, "both").when(in_left, "lost").otherwise("added")
        .alias("presence"), *flags)


_CHANGED = " OR ".join(f"{name}_changed" for name in AUDITED)


# Buckets into which an audit divides the records.
AUDIT_BUCKETS = 1024


def fingerprint_metrics(names: Sequence[str]) -> list[Column]:
    """Order-free fingerprint of a set of rows: their number and the exclusive or and sum
    of two hashes. A null differs from every value and from a null in another column."""
    values = [part for name in names for part in (F.col(name).isNull(), F.col(name))]
    return [F.count("*").alias("n"), F.bit_xor(F.xxhash64(*values)).alias("x"),
            F.sum(F.xxhash64(F.lit(1), *values).cast("decimal(38,0)")).alias("s")]


def _bucket(names: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")


def _suspect(left: DataFrame, right: DataFrame, key: Sequence[str], names: Sequence[str],
             buckets: int) -> tuple[list[int], int]:
    """Buckets of the key whose fingerprints differ, and the rows in the others.

    Each side is reduced to one row per task and bucket; no record is shuffled.
    """
    def marked(side: DataFrame, prefix: str) -> DataFrame:
        marks = side.groupBy(_bucket(key, buckets).alias("bucket")).agg(
            *fingerprint_metrics(names))
        return marks.select("bucket", *[F.col(c).alias(prefix + c) for c in ("n", "x", "s")])
    both = marked(left, "l").join(marked(right, "r"), "bucket", "full_outer").select(
        "bucket", "ln", (F.col("ln").eqNullSafe(F.col("rn")) & F.col("lx").eqNullSafe(F.col("rx"))
                         & F.col("ls").eqNullSafe(F.col("rs"))).alias("same")).collect()
    return (sorted(row["bucket"] for row in both if not row["same"]),
            sum(row["ln"] for row in both if row["same"]))


def _within(side: DataFrame, key: Sequence[str], buckets: int, chosen: list[int]) -> DataFrame:
    return side.filter(_bucket(key, buckets).isin(chosen) if chosen else F.lit(False))


def _named(key: Sequence[str]) -> list[str]:
    return [*key, "hourly_timestamp", *AUDITED]


def roundtrip_audit(written: DataFrame, reread: DataFrame, key: list[str],
                    buckets: int = AUDIT_BUCKETS) -> DataFrame:
    """Records that differ between the source and what was read back.

    ``key`` identifies a record on both sides. One ``<field>_changed`` flag per
    audited field, and ``presence``: ``both``, ``lost`` or ``added``. Both sides are
    fingerprinted by buckets of the key first, and only the records of buckets that
    differ are joined; of an undamaged store that is none.
    """
    chosen, _ = _suspect(written, reread, key, _named(key), buckets)
    return _paired(_within(written, key, buckets, chosen),
                   _within(reread, key, buckets, chosen), key).filter(_CHANGED)


def roundtrip_summary(written: DataFrame, reread: DataFrame, key: list[str],
                      buckets: int = AUDIT_BUCKETS) -> DataFrame:
    """Number of records compared and damaged."""
    chosen, same = _suspect(written, reread, key, _named(key), buckets)
    return _paired(_within(written, key, buckets, chosen),
                   _within(reread, key, buckets, chosen), key).agg(
        (F.count("*") + F.lit(same).cast("bigint")).alias("compared"),
        F.count_if(F.expr(_CHANGED)).alias("damaged"))


def record_differences(source: DataFrame, stored: DataFrame,
                       buckets: int = AUDIT_BUCKETS) -> DataFrame:
    """Records without a key: those that source and store do not hold equally often.

    Compares the columns of ``source``; adds ``in_source`` and ``in_store``.
    """
    names = source.columns
    stored = stored.select(*names)
    chosen, _ = _suspect(source, stored, names, names, buckets)
    sides = [_within(side, names, buckets, chosen).withColumn("side", F.lit(place))
             for place, side in enumerate((source, stored))]
    return sides[0].unionByName(sides[1]).groupBy(*names).agg(
        F.count_if(F.col("side") == 0).alias("in_source"),
        F.count_if(F.col("side") == 1).alias("in_store")).filter("in_source <> in_store")
