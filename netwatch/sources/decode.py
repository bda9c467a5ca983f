"""Wire frame -> typed events.

``from_json`` runs permissive: a malformed record becomes a row of NULLs and
is kept (the archive keeps it too). ``split_rejects`` routes malformed rows and
rows without a required field to a dead-letter table instead of letting the
windowed rules drop them silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netwatch.functions.time import parse_event_time
from netwatch.operators.enrich import enrich_lookups
from netwatch.schemas import BGP_SCHEMA, BGP_SCHEMA_TYPED, DNS_SCHEMA


def _parse_once(wire: DataFrame, schema, extra: dict) -> DataFrame:
    """``from_json`` once per frame, record fields flattened next to ``extra``.

    A rule filter on a decoded field would otherwise be pushed into the
    parser call by Catalyst, and the text parsed twice: once for the filter,
    once for the projection. The one-element ``inline`` is a generator, which
    filters on its output do not cross.
    """
    text = F.col("value").cast("string")
    record = F.struct(F.from_json(text, schema).alias("data"),
                      *[c.alias(name) for name, c in extra.items()])
    return wire.select(F.inline(F.array(record))).select("data.*", *extra.keys())


def _narrow(schema: StructType, fields: Sequence[str] | None) -> StructType:
    """Only ``fields`` of the record (all when None): the parser builds no
    values for the others."""
    if not fields:
        return schema
    wanted = set(fields)
    return StructType([f for f in schema.fields if f.name in wanted])


def decode_routing(wire: DataFrame, typed_lists: bool = False,
                   event_time: str = "broker", keep_raw: bool = False,
                   fields: Sequence[str] | None = None) -> DataFrame:
    """Routing frames -> typed updates plus ``kafka_ts`` and ``event_time``.

    ``event_time`` is the broker timestamp by default (the payload time is
    decoded but not used), or ``"payload"`` for the record's own time.
    ``fields`` limits the decoded record fields to those a consumer reads.
    """
    if fields and event_time != "broker":
        fields = [*fields, "timestamp"]
    schema = _narrow(BGP_SCHEMA_TYPED if typed_lists else BGP_SCHEMA, fields)
    extra = {"kafka_ts": F.col("timestamp")}
    if keep_raw:
        extra["raw_value"] = F.col("value").cast("string")
    out = _parse_once(wire, schema, extra)
    t = F.col("kafka_ts") if event_time == "broker" else parse_event_time("timestamp")
    return out.withColumn("event_time", t)


def decode_lookups(wire: DataFrame, enrich: bool = True, keep_raw: bool = False,
                   fields: Sequence[str] | None = None) -> DataFrame:
    """Lookup frames -> typed events; ``event_time`` is the payload time.

    With ``enrich`` the name length (never sent) and a missing entropy are
    computed from the queried name (when it is decoded). ``fields`` limits
    the decoded record fields to those a consumer reads.
    """
    schema = _narrow(DNS_SCHEMA, [*fields, "timestamp"] if fields else None)
    extra = {"raw_value": F.col("value").cast("string")} if keep_raw else {}
    out = _parse_once(wire, schema, extra)
    out = out.withColumn("event_time", parse_event_time("timestamp"))
    if enrich and "queried_domain" in out.columns:
        out = enrich_lookups(out)
    return out


# Without these a record takes part in no rule of its source.
ROUTING_REQUIRED = ("event_time", "prefix", "event_type")
LOOKUP_REQUIRED = ("event_time", "source_ip")


def reject_reason(decoded: DataFrame, required: Sequence[str] = ("event_time",)) -> Column:
    """Why a decoded row is unusable, NULL when it is not: the required
    fields it lacks, or "malformed" when it has those (an event time may come
    from the frame) but no field of the record could be read."""
    own = [c for c in decoded.columns if c in set(BGP_SCHEMA.names) | set(DNS_SCHEMA.names)]
    # Filled in after decoding, not read from the record.
    own = [c for c in own if c not in ("entropy", "domain_length")]
    empty = F.coalesce(*[F.col(c).cast("string") for c in own]).isNull()
    lacking = F.concat_ws(",", *[F.when(F.col(n).isNull(), F.lit(f"missing {n}")) for n in required])
    return F.when(lacking != "", lacking).when(empty, F.lit("malformed"))


def split_rejects(decoded: DataFrame, required: Sequence[str] = ("event_time",)
                  ) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows with a ``reject_reason``)."""
    reason = reject_reason(decoded, required)
    return (decoded.filter(reason.isNull()),
            decoded.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull()))


def keep_raw_of_rejects(decoded: DataFrame, required: Sequence[str]) -> DataFrame:
    """Blank the raw text of usable rows: a micro-batch that is cached for
    several outputs then holds it only where the dead letters need it."""
    unusable = reject_reason(decoded, required).isNotNull()
    return decoded.withColumn("raw_value", F.when(unusable, F.col("raw_value")))
