"""Event messages: publish rows as JSON, take JSON in, keep what was refused.

One definition serves batch and stream: the functions take any DataFrame with a
text column, static or streaming.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import text, values
from tallyline.sources.schemas import EVENT_FIELDS

REJECT = "reject_reason"


def read_event_stream(
    spark: SparkSession, fmt: str, path: str | None = None, schema: str | None = None, **options: str
) -> DataFrame:
    """Streaming intake with one text column ``value``.

    ``kafka`` (where the connector is installed) and file formats are told apart
    only by the format name and options. Intake per trigger is bounded with
    ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    lines = reader.load(path) if path else reader.load()
    return lines.withColumn("value", F.col("value").cast("string"))


def event_rows(
    df: DataFrame,
    aliases: Mapping[str, Sequence[str]] | None = None,
    fields: Mapping[str, str] = EVENT_FIELDS,
    required: Sequence[str] = ("case_number", "date", "block", "primary_type"),
) -> DataFrame:
    """Rows of a table as typed message fields; rows without a required field go.

    ``aliases`` lists, per field, the columns that may hold it, best first.
    """
    named = text.standard_columns(df)
    lenient = {
        "text": text.strip,
        "area": text.area_code,
        "boolean": values.lenient_bool,
        "number": values.safe_number,
    }
    sources = {f: text.first_usable(named, (aliases or {}).get(f, (f,))) for f in fields}
    usable = named.where(text.all_present(sources[f] for f in required))
    return usable.select(*(lenient[kind](sources[f]).alias(f) for f, kind in fields.items()))


def to_messages(rows: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON text per row in ``value``, with a partition key where asked."""
    message = F.to_json(F.struct(*rows.columns)).alias("value")
    return rows.select(message) if key is None else rows.select(F.col(key).alias("key"), message)


def publish(messages: DataFrame, fmt: str = "text", path: str | None = None, **options: str) -> None:
    """Write messages to Kafka or to text files."""
    writer = messages.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("overwrite").save(path)


def parse_events(
    lines: DataFrame,
    fields: Mapping[str, str] = EVENT_FIELDS,
    nullable: Sequence[str] = ("district",),
    value: str = "value",
) -> DataFrame:
    """Decode, validate and coerce; ``reject_reason`` is NULL for good events.

    Fields must be there with text, except the ``nullable`` ones, which must be
    there but may be null. Booleans and numbers are strict. The checks run in
    field order after the check of presence, and the first failure is reported.
    """
    # Decode once: a filter on the reason, or any other later step, would otherwise
    # be pushed down with a copy of the decoding for every mention of a field. Spark
    # moves nothing through a generator.
    entry = F.from_json(F.col(value), "map<string,string>")
    decoded = lines.select("*", F.explode(F.array(entry)).alias("_entry"))
    found = F.col("_entry")

    reason = F.when(found.isNull(), F.lit("not_json"))
    for name in fields:
        present = (
            F.map_contains_key(found, F.lit(name))
            if name in nullable
            else text.has_text(F.try_element_at(found, F.lit(name)))
        )
        reason = reason.when(~present, F.lit(f"missing_{name}"))

    strict = {
        "text": text.strip,
        "area": text.area_code,
        "boolean": values.strict_bool,
        "number": values.number,
    }
    typed: dict[str, Column] = {
        name: strict[kind](F.try_element_at(found, F.lit(name))) for name, kind in fields.items()
    }
    for name, kind in fields.items():
        if kind in ("boolean", "number"):
            reason = reason.when(typed[name].isNull(), F.lit(f"bad_{name}"))

    return decoded.select(
        *(c for c in lines.columns), *(c.alias(n) for n, c in typed.items()), reason.alias(REJECT)
    )


def accepted(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Good events, without the raw text."""
    return parsed.where(F.col(REJECT).isNull()).drop(REJECT, value)


def quarantined(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Refused events: the raw text and why."""
    return parsed.where(F.col(REJECT).isNotNull()).select(value, REJECT)


def event_time(date: Column, basis: str = "event", arrival: Column | None = None) -> Column:
    """Event time with arrival time as the fall-back, or arrival time always.

    ``arrival`` is when each message came in, as its source tells it (Kafka's
    ``timestamp``). Without it the arrival of a message is not known: the moment of
    processing is one for a whole micro-batch and would pile its events up in one
    second, so it only stands in for an event time that cannot be read.
    """
    if basis not in ("event", "arrival"):
        raise ValueError(f"unknown time basis: {basis}")
    read = values.parse_time(date)
    if arrival is None:
        return F.coalesce(read, F.current_timestamp())
    return F.coalesce(arrival, read) if basis == "arrival" else F.coalesce(read, arrival)


def raw_documents(events: DataFrame, ingested_at: Column, case: str = "case_number", date: str = "date") -> DataFrame:
    """Optional raw event log: the event, its id and when it came in."""
    return events.select(
        values.event_id(F.col(case), F.col(date)).alias("event_id"),
        *events.columns,
        ingested_at.alias("ingested_at"),
    )


def retained(log: DataFrame, now: Column, ttl_seconds: int = 86400) -> DataFrame:
    """Raw log rows that are not older than the time to live."""
    return log.where(F.col("ingested_at") >= now - F.make_dt_interval(secs=F.lit(ttl_seconds)))
