"""Validation of raw message envelopes: the first failing check gives the reason and the detail.

No Python: the envelope and its payload are parsed once to VARIANT values. Types are told apart
strictly (true is no integer, 1.0 is no integer, neither is a number beyond 64 bits), and once for
a whole object: its schema as text tells the type of every field, so that a check is a search in
a short string. A record whose fields are all right passes one test; only others walk the ladder
that finds the first failure. Duplicate keys in JSON make it invalid here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adit.functions.scalar import strict_base64
from adit.sources.domain import CLASSES, DIRECTIONS, POSITIONS, SCHEMA_VERSION, STATUSES

ENVELOPE_CHARS = 4096
# Fields of the two kinds of payload, in the order in which they are looked at.
DETECTION_FIELDS = {
    "string": ("message_id", "sensor_id", "device_id", "device_serial", "tunnel_id", "position", "plate"),
    "integer": ("seq", "ts", "lane", "occupancy_ms"),
    "number": ("speed_kmh", "length_m", "confidence"),
    "enum": (("direction", DIRECTIONS), ("classification", CLASSES)),
}
HEALTH_FIELDS = {
    "string": ("sensor_id", "device_id", "device_serial", "tunnel_id", "position"),
    "integer": ("ts", "detections", "duplicates", "missed"),
    "number": ("window_s", "uptime_s"),
    "enum": (("status", STATUSES),),
}
TOPIC = "topic is not tunnels/{tunnel_id}/sensors/{start|middle|end}/{detections|health}"


def _get(v: str, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _kind(x: Column) -> Column:
    """Type of a variant value: null when the field is missing."""
    return F.schema_of_variant(x)


def _is(x: Column, what: str) -> Column:
    return _kind_is(F.coalesce(_kind(x), F.lit("")), what)


def _kind_is(kind: Column, what: str) -> Column:
    if what == "number":
        return (kind == "BIGINT") | (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL")
    return kind == {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN"}[what]


def _types(v: str) -> Column:
    """The fields of an object and their types, as ``, name: TYPE, name: TYPE,``.

    Null for what is no object, and for objects with nested values or names that need quotes: of
    those, fields are looked up one by one.
    """
    kind = _kind(F.col(v))
    plain = kind.startswith("OBJECT<") & ~F.contains(kind, F.lit("`")) & (F.instr(F.substring(kind, 8, 1 << 30), "<") == 0)
    return F.when(plain, F.concat(F.lit(", "), F.substring(kind, F.lit(8), F.length(kind) - 8), F.lit(",")))


def _has(types: str, name: str, what: str) -> Column:
    at = lambda kind: F.contains(F.col(types), F.lit(f", {name}: {kind}"))
    if what == "number":
        return at("BIGINT,") | at("DOUBLE,") | at("DECIMAL(") | at("FLOAT,")
    return at({"string": "STRING,", "integer": "BIGINT,", "boolean": "BOOLEAN,"}[what])


def _field_is(v: str, types: str, name: str, what: str) -> Column:
    """Whether a field has this type."""
    return F.when(F.col(types).isNotNull(), _has(types, name, what)).otherwise(_is(_get(v, name), what))


def _string(v: str, types: str, name: str) -> Column:
    """The value of a field that is a string."""
    return F.when(_field_is(v, types, name, "string"), F.try_variant_get(v, f"$.{name}", "string"))


def _text(x: Column) -> Column:
    return F.when(_is(x, "string"), F.try_variant_get(x, "$", "string"))


def _quote(x: Column) -> Column:
    return F.concat(F.lit("'"), x, F.lit("'"))


def _all_good(types: str, fields: dict, extra: tuple[str, ...] = ()) -> Column:
    """Whether all fields are there with their types and values (enums as columns of their names)."""
    typed = [_has(types, n, what) for what in ("string", "integer", "number") for n in fields[what]]
    typed += [_has(types, n, "boolean") for n in extra] + [F.col(f"_{n}").isin(*allowed) for n, allowed in fields["enum"]]
    return F.coalesce(reduce(lambda a, b: a & b, typed), F.lit(False))


def _field_error(kinds: Column, fields: dict, booleans: tuple[str, ...] = ()) -> Column:
    """The first message about a payload's fields, by their types (a map): all present, then strings,
    integers, numbers, enums, and last the booleans, each as to both."""
    first = lambda names, fails: F.get(F.filter(F.array(*map(F.lit, names)), fails), F.lit(0))
    missing = lambda n: ~F.map_contains_key(kinds, n)
    plain = [*fields["string"], *fields["integer"], *fields["number"], *[n for n, _ in fields["enum"]]]
    of = lambda what: lambda n: ~_kind_is(F.try_element_at(kinds, n), what)
    errors = [F.concat(F.lit("missing field '"), first(plain, missing), F.lit("'"))]
    for what, word in (("string", "a string"), ("integer", "an integer"), ("number", "a number")):
        errors.append(F.concat(F.lit("field '"), first(fields[what], of(what)), F.lit(f"' must be {word}")))
    for name, allowed in fields["enum"]:
        errors.append(F.when(~F.coalesce(F.col(f"_{name}").isin(*allowed), F.lit(False)), F.lit(f"field '{name}' must be one of {'|'.join(sorted(allowed))}")))
    for name in booleans:
        errors += [F.when(missing(F.lit(name)), F.lit(f"missing field '{name}'")), F.when(of("boolean")(F.lit(name)), F.lit(f"field '{name}' must be a boolean"))]
    return F.coalesce(*errors)


def _first(checks: list[tuple[Column, Column]]) -> Column:
    out = F.when(*checks[0])
    return reduce(lambda acc, c: acc.when(*c), checks[1:], out)


def validated(raw: DataFrame, value: str = "value", now_ms: Column | None = None) -> DataFrame:
    """``raw`` with ``kind`` (detection, health, rejected), ``key``, ``reason``, ``detail`` and the record.

    The record is JSON: the payload with received_ts, processed_ts and tbmq_node, or the rejection.
    A column of the source by one of these names, as a broker's ``key``, becomes ``record_<name>``.
    """
    raw = raw.withColumnsRenamed({c: f"record_{c}" for c in raw.columns if c.lower() in ("kind", "key", "reason", "detail", "record") and c != value})
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    text = F.when(F.is_valid_utf8(F.col(value).cast("string")), F.col(value).cast("string"))
    df = raw.withColumn("_e", F.try_parse_json(text)).withColumn("_t", _types("_e"))
    ts = F.when(_field_is("_e", "_t", "ts", "integer"), F.try_variant_get("_e", "$.ts", "bigint"))
    df = df.withColumns({"_topic": _string("_e", "_t", "topicName"), "_cn": _string("_e", "_t", "clientCertCn"), "_ts": ts, "_node": _string("_e", "_t", "tbmqNode"), "_payload": _string("_e", "_t", "payload")})
    df = df.withColumn("_bytes", strict_base64(F.col("_payload"))).withColumn("_parts", F.split("_topic", "/", -1))
    part = lambda k: F.get("_parts", F.lit(k))
    good_topic = (F.size("_parts") == 5) & (part(0) == "tunnels") & (part(1) != "") & (part(2) == "sensors") & part(3).isin(*POSITIONS) & part(4).isin("detections", "health")
    df = df.withColumns({"_good": F.coalesce(good_topic, F.lit(False)), "_tunnel": part(1), "_position": part(3), "_health": F.coalesce(part(4) == "health", F.lit(False))})
    body = F.col("_bytes").cast("string")
    df = df.withColumn("_p", F.try_parse_json(F.when(F.is_valid_utf8(body), body))).withColumn("_pt", _types("_p"))
    names = ("tunnel_id", "position", "sensor_id", "direction", "classification", "status")
    df = df.withColumns({f"_{n}" if n not in ("tunnel_id", "position") else f"_own_{n}": _string("_p", "_pt", n) for n in names})
    version = F.when(_field_is("_p", "_pt", "schema", "integer"), F.try_variant_get("_p", "$.schema", "bigint"))
    fits = F.when(F.col("_health"), _all_good("_pt", HEALTH_FIELDS, ("degraded",))).otherwise(_all_good("_pt", DETECTION_FIELDS))
    df = df.withColumns({"_known": F.coalesce(version == SCHEMA_VERSION, F.lit(False)), "_fits": fits})
    own, due = [F.col("_own_tunnel_id"), F.col("_own_position"), F.col("_sensor_id")], [F.col("_tunnel"), F.col("_position"), F.concat("_tunnel", F.lit("-"), "_position")]
    same = reduce(lambda a, b: a & b, [a == b for a, b in zip(own, due, strict=True)])
    right_cn = F.coalesce(F.col("_cn") == F.col("_tunnel"), F.lit(False))
    whole = F.col("_ts").isNotNull() & F.col("_bytes").isNotNull() & F.col("_good") & right_cn & F.col("_known") & F.col("_fits") & F.coalesce(same, F.lit(False))
    df = df.withColumn("_whole", whole)
    # types of the fields, one by one, of those alone that have a wrong one
    is_object = lambda v, types: F.col(types).isNotNull() | F.coalesce(_kind(F.col(v)).startswith("OBJECT"), F.lit(False))
    looked = ~F.col("_whole") & ~F.col("_fits") & F.col("_known") & F.col("_good") & right_cn
    kinds = F.transform_values(F.col("_p").cast("map<string,variant>"), lambda _, v: F.coalesce(_kind(v), F.lit("VOID")))
    df = df.withColumn("_kinds", F.when(looked & is_object("_p", "_pt"), kinds))
    fields = F.when(F.col("_health"), _field_error(F.col("_kinds"), HEALTH_FIELDS, ("degraded",))).otherwise(_field_error(F.col("_kinds"), DETECTION_FIELDS))
    df = df.withColumn("_fields", F.when(F.col("_kinds").isNotNull(), fields))
    cn, schema = _get("_e", "clientCertCn"), _get("_p", "schema")
    shown = F.when(_is(schema, "string"), _quote(F.try_variant_get(schema, "$", "string"))).otherwise(
        F.when(_kind(schema) == "VOID", F.lit("None")).when(_is(schema, "boolean"), F.initcap(F.to_json(schema))).otherwise(F.to_json(schema))
    )
    slashed = lambda xs: F.concat_ws("/", *map(_quote, xs))
    ladder = [
        (F.col(value).isNull(), "bad_envelope", F.lit("record value is null")),
        (F.col("_e").isNull(), "bad_envelope", F.lit("envelope is not valid UTF-8 JSON")),
        (~is_object("_e", "_t"), "bad_envelope", F.lit("envelope is not a JSON object")),
        (F.col("_topic").isNull(), "bad_envelope", F.lit("topicName missing or not a string")),
        (F.col("_payload").isNull(), "bad_envelope", F.lit("payload missing or not a string")),
        (F.col("_bytes").isNull(), "bad_envelope", F.lit("payload is not valid base64")),
        (F.col("_ts").isNull(), "bad_envelope", F.lit("ts missing or not an integer")),
        (~F.col("_good"), "bad_topic", F.lit(TOPIC)),
        (F.col("_cn").isNull() & (F.coalesce(_kind(cn), F.lit("VOID")) == "VOID"), "identity_mismatch", F.lit("clientCertCn missing")),
        (~right_cn, "identity_mismatch", F.concat(F.lit("clientCertCn "), F.coalesce(_quote(F.col("_cn")), F.to_json(cn)), F.lit(" != topic tunnel_id "), _quote(F.col("_tunnel")))),
        (F.col("_p").isNull(), "bad_payload", F.lit("payload is not valid UTF-8 JSON")),
        (~is_object("_p", "_pt"), "bad_payload", F.lit("payload is not a JSON object")),
        (~F.col("_known") & _kind(schema).isNull(), "bad_payload", F.lit("missing field 'schema'")),
        (~F.col("_known"), "unsupported_schema", F.concat(F.lit("schema "), shown, F.lit(f" (supported: {SCHEMA_VERSION})"))),
        (F.when(F.col("_pt").isNotNull(), ~F.col("_fits")).otherwise(F.col("_fields").isNotNull()), "bad_payload", F.col("_fields")),
        (~F.coalesce(same, F.lit(False)), "payload_mismatch", F.concat(F.lit("payload tunnel_id/position/sensor_id "), slashed(own), F.lit(" != topic "), slashed(due))),
    ]
    # the ladder in two parts, each a column of its own: small enough to be compiled
    of_part = lambda low, high: _first([(fails, F.lit(k)) for k, (fails, _, _) in enumerate(ladder) if low <= k < high])
    df = df.withColumn("_early", F.when(~F.col("_whole"), of_part(0, 10)))
    df = df.withColumn("_late", F.when(~F.col("_whole") & F.col("_early").isNull(), of_part(10, len(ladder))))
    step = F.when(F.col("_early").isNotNull(), F.col("_early")).when(F.col("_late").isNotNull(), F.col("_late"))
    df = df.withColumn("_step", step).withColumn("_now", now)
    reason = F.get(F.array(*[F.lit(r) for _, r, _ in ladder]), F.col("_step"))
    detail = _first([(F.col("_step") == k, d) for k, (_, _, d) in enumerate(ladder)])
    df = df.withColumns({"_reason": reason, "_detail": detail})
    cut = F.substring(F.coalesce(F.make_valid_utf8(F.col(value).cast("string")), F.lit("")), 1, ENVELOPE_CHARS)
    rejection = F.to_json(
        F.struct(F.col("_reason").alias("reason"), F.col("_detail").alias("detail"), F.col("_topic").alias("topic"), F.col("_cn").alias("client_cert_cn"), F.col("_ts").alias("received_ts"), F.col("_now").alias("processed_ts"), cut.alias("envelope")),
        {"ignoreNullFields": "false"},
    )
    added = F.to_json(F.struct(F.col("_ts").alias("received_ts"), F.col("_now").alias("processed_ts"), F.col("_node").alias("tbmq_node")), {"ignoreNullFields": "false"})
    inner = F.regexp_replace(F.to_json("_p"), r"\}$", "")
    record = F.concat(inner, F.lit(","), F.substring(added, 2, F.length(added)))
    kind = F.when(F.col("_step").isNotNull(), "rejected").when(F.col("_health"), "health").otherwise("detection")
    return df.select(
        *[F.col(c) for c in raw.columns], kind.alias("kind"), F.when(F.col("_good"), F.col("_tunnel")).alias("key"), F.col("_reason").alias("reason"), F.col("_detail").alias("detail"),
        F.when(F.col("_step").isNotNull(), rejection).otherwise(record).alias("record"),
    )


def rejected_late(raw: DataFrame, reason: str, detail: str, value: str = "value", now_ms: Column | None = None) -> DataFrame:
    """Records that failed after validation (the producer refused them), as rejections: ``raw`` with ``key, reason, record``.

    Of the envelope only what can be read is told; the key is the tunnel of any topic of five parts.
    """
    text = F.when(F.is_valid_utf8(F.col(value).cast("string")), F.col(value).cast("string"))
    df = raw.withColumn("_e", F.try_parse_json(text))
    ts = _get("_e", "ts")
    df = df.withColumns({"_topic": _text(_get("_e", "topicName")), "_cn": _text(_get("_e", "clientCertCn")), "_ts": F.when(_is(ts, "integer"), F.try_variant_get(ts, "$", "bigint"))})
    parts = F.split("_topic", "/", -1)
    tunnel = F.get(parts, F.lit(1))
    cut = F.substring(F.coalesce(F.make_valid_utf8(F.col(value).cast("string")), F.lit("")), 1, ENVELOPE_CHARS)
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    record = F.to_json(
        F.struct(F.lit(reason).alias("reason"), F.lit(detail).alias("detail"), F.col("_topic").alias("topic"), F.col("_cn").alias("client_cert_cn"), F.col("_ts").alias("received_ts"), now.alias("processed_ts"), cut.alias("envelope")),
        {"ignoreNullFields": "false"},
    )
    return df.select(*[F.col(c) for c in raw.columns], F.when((F.size(parts) == 5) & (tunnel != ""), tunnel).alias("key"), F.lit(reason).alias("reason"), record.alias("record"))


def strict_detections(typed: DataFrame) -> DataFrame:
    """Typed detections with ``invalid``, the first reason not to fuse one (null: none), and ``boot_id``,
    the last part but one of a message id of three parts or more."""
    where = (F.col("direction").isin(*DIRECTIONS) & F.col("position").isin(*POSITIONS)).eqNullSafe(F.lit(True))
    known = F.col("classification").isin(*CLASSES).eqNullSafe(F.lit(True))
    shown = lambda c: F.coalesce(_quote(F.col(c)), F.lit("None"))
    invalid = (
        F.when(~F.col("schema").eqNullSafe(F.lit(SCHEMA_VERSION)), F.concat(F.lit("unsupported schema "), F.coalesce(F.col("schema").cast("string"), F.lit("None"))))
        .when(~where, F.concat(F.lit("bad direction/position "), shown("direction"), F.lit("/"), shown("position")))
        .when(~known, F.concat(F.lit("bad classification "), shown("classification")))
        .when(~(F.col("speed_kmh") > 0).eqNullSafe(F.lit(True)), F.lit("speed_kmh must be > 0"))
    )
    return typed.withColumns({"invalid": invalid, "boot_id": F.regexp_extract("message_id", r":([^:]*):[^:]*$", 1)})


def split_3way(checked: DataFrame) -> dict[str, DataFrame]:
    """The three outputs, keyed by tunnel: what each topic or table gets.

    ``checked`` should be persisted: it is read three times, and filters on its kind would
    otherwise be pushed below the parsing and repeat it for every check.
    """
    return {kind: checked.where(F.col("kind") == kind).select("key", F.col("record").alias("value")) for kind in ("detection", "health", "rejected")}
