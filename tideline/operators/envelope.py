"""Change envelopes: to JSON text, from JSON text, to table columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import model as m
from tideline.functions.decoding import decodable, from_text
from tideline.functions.json_text import object_text, or_empty
from tideline.functions.temporal import NATIVE, render_temporal


#: Logical types by field, or by ``db.table`` and field.
Temporal = dict[str, str | dict[str, str]]


def _cases(temporal: Temporal) -> list[tuple[Column | None, str, str]]:
    """(which rows, field, logical type); a table's own types come before those of all tables."""
    name = F.concat(F.trim("source.db"), F.lit("."), F.trim("source.table"))
    own = [(name == table, f, logical) for table, fields in temporal.items() if isinstance(fields, dict) for f, logical in fields.items()]
    return own + [(None, f, logical) for f, logical in temporal.items() if isinstance(logical, str)]


def _loose_text(key: Column, raw: Column, temporal: Temporal, tz: str, compat: bool) -> Column:
    """The temporal text of a field of an untyped image; null where it has none."""
    out = None
    for rows, field, logical in _cases(temporal):
        here = (key == field) if rows is None else rows & (key == field)
        zoned = logical == m.ZONED
        text = render_temporal(raw if zoned else raw.try_cast("bigint"), logical, None if zoned else tz, compat, "string" if zoned else "bigint")
        out = F.when(here, text) if out is None else out.when(here, text)
    return F.lit(None).cast("string") if out is None else out


def _struct_fields(df: DataFrame, name: str, temporal: Temporal, tz: str, compat: bool) -> list[tuple[str, list[tuple[Column | None, Column]]]]:
    """Each field of a struct image with its forms: (which rows, value), the last one for all others."""
    out, image = [], F.col(name)
    for f in df.schema[name].dataType.fields:
        kind, col = f.dataType.simpleString(), image[f.name]

        def shown(logical: str | None, col: Column = col, kind: str = kind, dtype: T.DataType = f.dataType) -> Column:
            # 32-bit times stay numbers in compat mode
            raw = compat and logical == m.TIME_MS and isinstance(dtype, T.IntegerType)
            if not logical or raw:
                return col
            return render_temporal(col, logical, None if logical == m.ZONED else tz, compat, kind)

        cases = [(rows, logical) for rows, field, logical in _cases(temporal) if field == f.name]
        if not cases or cases[-1][0] is not None:
            cases.append((None, NATIVE.get(kind)))
        out.append((f.name, [(rows, shown(logical)) for rows, logical in cases]))
    return out


def _image(df: DataFrame, name: str, temporal: Temporal, tz: str, compat: bool) -> Column:
    """An image for ``to_json``: ``{}`` when absent, ``""`` for null fields."""
    dtype, image = df.schema[name].dataType, F.col(name)
    if isinstance(dtype, T.MapType):
        filled = F.transform_values(
            image, lambda k, v: F.coalesce(_loose_text(k, v.cast("string"), temporal, tz, compat), v.cast("string"), F.lit(""))
        )
        return F.coalesce(filled, F.create_map().cast("map<string,string>")).alias(name)
    if not isinstance(dtype, T.StructType):
        fields = F.variant_get(F.parse_json(F.coalesce(image, F.lit("{}"))), "$", "map<string,variant>")

        def value(k: Column, v: Column) -> Column:
            text = _loose_text(k, F.try_variant_get(v, "$", "string"), temporal, tz, compat)
            empty = v.isNull() | F.is_variant_null(v)
            return F.when(empty, F.lit("").cast("variant")).when(text.isNotNull(), text.cast("variant")).otherwise(v)

        return F.transform_values(fields, value).alias(name)
    written = []
    for field, forms in _struct_fields(df, name, temporal, tz, compat):
        before = F.lit(False)
        for rows, col in forms:  # one of several fields of one name is not null
            here = ~before if rows is None else rows & ~before
            written.append((col if len(forms) == 1 else F.when(here, col)).alias(field))
            before = F.lit(True) if rows is None else before | F.coalesce(rows, F.lit(False))
        written.append(F.when(image.isNotNull() & image[field].isNull(), "").alias(field))
    return F.struct(*written).alias(name)


def image_texts(df: DataFrame, temporal: Temporal | None = None, tz: str = "UTC", compat: bool = False) -> DataFrame:
    """Both struct images with temporal fields as the envelope shows them; other images stay."""
    images = {}
    for name in ("before", "after"):
        if isinstance(df.schema[name].dataType, T.StructType):
            fields = []
            for field, forms in _struct_fields(df, name, temporal or {}, tz, compat):
                out = None
                for rows, col in forms:
                    col = col if len(forms) == 1 else col.cast("string")
                    out = (F.when(rows, col) if out is None else out.when(rows, col)) if rows is not None else (col if out is None else out.otherwise(col))
                fields.append(out.alias(field))
            images[name] = F.when(F.col(name).isNotNull(), F.struct(*fields))
    return df.withColumns(images)


def normalize_envelope(
    df: DataFrame,
    temporal: Temporal | None = None,
    tz: str = "UTC",
    compat: bool = False,
) -> DataFrame:
    """Add ``value``: the change as one JSON object with its six members.

    Absent images become ``{}``, null fields and a null transaction ``""``; null
    ``op`` and ``ts_ms`` are left out. ``temporal`` maps field names to logical
    types, and ``db.table`` to such a map of its own; the rules hold for images of any type: structs, maps and
    JSON texts. Timestamps of Spark's own types need none. Numbers of texts keep up to 38 digits. Rows without ``source`` are no data changes and are dropped.
    """
    images = [_image(df, name, temporal or {}, tz, compat) for name in ("before", "after", "source")]
    text = object_text(*images, F.col("op"), F.col("ts_ms"), *or_empty("transaction", F.col("transaction")))
    return df.filter(F.col("source").isNotNull()).withColumn("value", text)


def _payload(root: str) -> Column:
    return F.try_variant_get(root, "$.payload", "variant")


def unwrap_payload(df: DataFrame, column: str = "value") -> DataFrame:
    """Replace a ``{"payload": …}`` wrapper by the payload; bare envelopes, and those whose payload is
    null, stay as they are.

    Numbers of up to 38 digits keep their value, but not a zero at the end of a fraction; members are
    ordered by name.
    """
    text = F.col(column)
    payload = _payload(F.try_parse_json(text))
    return df.withColumn(column, F.when(F.is_variant_null(payload), text).otherwise(F.coalesce(F.to_json(payload), text)))


_SHARED = ("op", "ts_ms", "transaction")


def _exact_names(schema: T.StructType) -> set[str]:
    """Fields whose numbers may have more digits than a double."""
    return {f.name for f in schema.fields if not isinstance(f.dataType, T.AtomicType) or isinstance(f.dataType, T.DecimalType)}


def _exact(value: Column, dtype: T.DataType, strict: bool) -> Column:
    """The text of a variant, its numbers with up to 38 digits; a decimal that has more fails, or is null."""
    text = F.try_variant_get(value, "$", "string")
    if not isinstance(dtype, T.DecimalType):
        return text
    digits = F.length(F.regexp_replace(F.regexp_replace(text, "E.*", ""), "[^0-9]", ""))
    wrong = F.raise_error(F.lit("a number has more than 38 digits")).cast("string") if strict else F.lit(None).cast("string")
    return F.when((F.schema_of_variant(value) == "DOUBLE") & (digits > 15), wrong).otherwise(text)


def _members(df: DataFrame, keep: list[str], column: str, fields: list[str], exact: set[str], source: T.StructType, strict: bool) -> DataFrame:
    """``keep``, and the members of each envelope as texts, in one parse: images and source as structs of texts.

    Struct fields are named by their place. Images of ``exact`` fields come as variants besides, from a second
    parse, which is left out where there are none.
    """

    def texts(names: list[str]) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in names])

    own = T.StructType([T.StructField(side, texts(fields)) for side in ("before", "after")] + [T.StructField("source", texts(source.names))])
    for name in _SHARED:
        own = own.add(name, T.StringType())
    whole = T.StructType([*own.fields, T.StructField("payload", own)])
    parsed = F.from_json(column, whole, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    # only where a text may have a payload that is null is it looked at again
    lost = F.col("_e.payload").isNull() & F.contains(column, F.lit('"payload"')) & F.is_variant_null(_payload(F.try_parse_json(column)))
    more = [(F.parse_json if strict else F.try_parse_json)(column).alias("_v")] if exact else []
    read = df.select(*keep, column, parsed.alias("_e"), *more)
    payload = F.when(F.col("_e.payload").isNotNull(), F.col("_e.payload")).when(F.col("_e").isNotNull(), F.struct(*[F.col("_e")[f.name].alias(f.name) for f in own.fields]))
    if strict:
        empty = F.col("_e").isNull() & F.col(column).isNotNull()
        payload = F.when(empty, F.raise_error(F.lit("an envelope is no JSON object")).cast(own)).when(
            lost, F.raise_error(F.lit("the payload of an envelope is null")).cast(own)).otherwise(payload)

    def placed(name: str, n: int) -> Column:
        return F.col("_e")[name].cast(texts([f"c{i}" for i in range(n)])).alias(f"_{name}")

    def variants(name: str) -> Column:
        # a path in a bare envelope, else in its payload
        some = [f for f in fields if f in exact]
        ddl = "struct<" + ",".join(f"`{f.replace('`', '``')}`:variant" for f in some) + ">"
        found = F.when(F.col("_wrapped"), F.try_variant_get("_v", f"$.payload.{name}", ddl)).otherwise(F.try_variant_get("_v", f"$.{name}", ddl))
        return found.cast(T.StructType([T.StructField(f"c{fields.index(f)}", T.VariantType()) for f in some])).alias(f"_exact_{name}")

    wrapped = F.col("_e.payload").isNotNull().alias("_wrapped")
    more = [variants("before"), variants("after")] if exact else []
    return read.select(*keep, payload.alias("_e"), *(["_v", wrapped] if exact else [])).select(
        *keep, *more, placed("before", len(fields)), placed("after", len(fields)), placed("source", len(source)),
        F.col("_e.op").alias("op"), F.nullif("_e.ts_ms", F.lit("")).alias("_ts_ms"), F.nullif("_e.transaction", F.lit("")).alias("transaction"),
    )


def _typed(image: str, schema: T.StructType, places: dict[str, int], strict: bool, empty_as_null: bool, temporal: dict[str, str]) -> Column:
    """The columns of an image from its texts; numbers and times may arrive as "" for null."""
    cols, exact = [], set() if image == "_source" else _exact_names(schema)
    for f in schema.fields:
        place = f"c{places[f.name]}"
        text = _exact(F.col(f"_exact{image}")[place], f.dataType, strict) if f.name in exact else F.col(image)[place]
        if empty_as_null or not isinstance(f.dataType, T.StringType):
            text = F.nullif(text, F.lit(""))
        cols.append(from_text(text, f.dataType, temporal.get(f.name), strict).alias(f.name))
    return F.struct(*cols)


def _present(image: str, schema: T.StructType, places: dict[str, int]) -> Column:
    # {} has no text in any field; a written image has some
    return F.coalesce(*[F.col(image)[f"c{places[f.name]}"] for f in schema.fields]).isNotNull()


def _shared(source: T.StructType, strict: bool) -> list[Column]:
    """The members of an envelope that are no images."""
    places = {name: k for k, name in enumerate(source.names)}
    typed = F.when(_present("_source", source, places), _typed("_source", source, places, strict, False, {}))
    ts_ms = F.col("_ts_ms")
    return [typed.alias("source"), F.col("op"), (ts_ms.cast("bigint") if strict else ts_ms.try_cast("bigint")).alias("ts_ms"), F.col("transaction")]


def parse_envelope(
    df: DataFrame,
    image: T.StructType | str,
    source: T.StructType | str = "db STRING, table STRING, ts_ms BIGINT",
    column: str = "value",
    mode: str = "FAILFAST",
    empty_as_null: bool = False,
    temporal: dict[str, str] | None = None,
) -> DataFrame:
    """JSON text, wrapped or bare, to a change frame in one parse per row.

    Fields are the inverse of what ``normalize_envelope`` writes (``functions.decoding``); ``temporal`` maps fields that
    hold numbers to the logical type by which they were shown. Decimals of up to 38 digits come out exactly as written,
    longer ones are values of the wrong type. Text that is no JSON object, a null payload, or a value of the wrong type, fails the job; ``mode="PERMISSIVE"``
    turns it into nulls instead. An empty text is null for all but string columns, for these too with ``empty_as_null``.
    """
    image, source = _struct(image), _struct(source)
    strict = mode == "FAILFAST"
    rest = [c for c in df.columns if c not in (column, "before", "after", "source", *_SHARED)]
    read = _members(df, rest, column, image.names, _exact_names(image), source, strict)
    places = {name: k for k, name in enumerate(image.names)}

    def side(name: str) -> Column:
        return F.when(_present(f"_{name}", image, places), _typed(f"_{name}", image, places, strict, empty_as_null, temporal or {})).alias(name)

    return read.select(*rest, side("before"), side("after"), *_shared(source, strict))


def parse_envelopes(
    df: DataFrame,
    images: dict[str, T.StructType | str],
    source: T.StructType | str = "db STRING, table STRING, ts_ms BIGINT",
    column: str = "value",
    mode: str = "FAILFAST",
    empty_as_null: bool = False,
    temporal: dict[str, dict[str, str]] | None = None,
    unknown: str = "error",
) -> DataFrame:
    """Envelopes of many tables to one change frame, in one parse per row.

    ``images`` maps ``db.table`` to the table's columns, which may differ in any way. Both images have one field per entry,
    named ``t0``, ``t1``, … in its order, of which only the own table's is not null; ``table_no`` is that number. A
    table that is not in ``images`` fails the job; with ``unknown="drop"`` its rows are left out. Everything else is
    as in ``parse_envelope``; ``temporal`` is by table.
    """
    schemas, source = {name: _struct(ddl) for name, ddl in images.items()}, _struct(source)
    strict = mode == "FAILFAST"
    fields = list(dict.fromkeys(name for schema in schemas.values() for name in schema.names))
    places = {name: k for k, name in enumerate(fields)}
    rest = [c for c in df.columns if c not in (column, "before", "after", "source", "table_no", *_SHARED)]
    exact = {name for schema in schemas.values() for name in _exact_names(schema)}
    read = _members(df, rest, column, fields, exact, source, strict)
    at = {name.lower(): f"c{k}" for k, name in enumerate(source.names)}
    name = F.concat(F.trim(F.col("_source")[at["db"]]), F.lit("."), F.trim(F.col("_source")[at["table"]]))
    number = F.try_element_at(F.create_map(*[F.lit(x) for pair in zip(schemas, range(len(schemas))) for x in pair]), name)
    if unknown == "error":
        wrong = F.raise_error(F.concat(F.lit("no columns are known of "), F.coalesce(name, F.lit("a change without a table")))).cast("int")
        number = F.when(number.isNull() & F.col("_source").isNotNull(), wrong).otherwise(number)
    read = read.withColumn("table_no", number).filter("table_no is not null")

    def side(image: str) -> Column:
        tables = []
        for k, (table, schema) in enumerate(schemas.items()):
            typed = _typed(f"_{image}", schema, places, strict, empty_as_null, (temporal or {}).get(table, {}))
            tables.append(F.when((F.col("table_no") == k) & _present(f"_{image}", schema, places), typed).alias(f"t{k}"))
        return F.struct(*tables).alias(image)

    read = read.select(*rest, side("before"), side("after"), *_shared(source, strict), "table_no")
    present = {image: F.coalesce(*[F.when(F.col(image)[f"t{k}"].isNotNull(), 1) for k in range(len(schemas))]).isNotNull() for image in ("before", "after")}
    return read.withColumns({image: F.when(there, F.col(image)) for image, there in present.items()})


def _struct(schema: T.StructType | str) -> T.StructType:
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    for f in schema.fields:
        if not decodable(f.dataType):
            raise ValueError(f"column {f.name} has the type {f.dataType.simpleString()}, which no envelope shows")
    return schema


def flatten_changes(env: DataFrame, schema: T.StructType | str, temporal: dict[str, str] | None = None) -> DataFrame:
    """The declared table columns of each change, next to ``op``, ``db``, ``table``.

    Deletes show the columns of the row they remove. ``env`` is a change frame,
    or has the JSON text in ``value``, which ``temporal`` helps to read.
    """
    schema = _struct(schema)
    if "after" not in env.columns:
        env = parse_envelope(env, schema, temporal=temporal)
    removed = F.col("op") == m.OP_DELETE

    def field(f: T.StructField) -> Column:
        value = F.when(removed, F.col("before")[f.name]).otherwise(F.col("after")[f.name])
        return value.cast(f.dataType).alias(f.name)

    return env.select(
        "op",
        F.col("source.db").alias("db"),
        F.col("source.table").alias("table"),
        "ts_ms",
        *[field(f) for f in schema.fields],
    )
