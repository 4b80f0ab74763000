"""Raw event ingest: JSON documents -> flat records routed to per-event topics.

One pass over the documents, no schema and no action beforehand:

1. read the routed fields (type, event, timestamp, ids) of each document by path,
   as column expressions: one ``from_json`` a document, which also checks that
   the whole document is JSON, at any depth;
2. stamp ``segment_timestamp`` (epoch ms of the ISO-8601 UTC ``timestamp``)
   and ``ingest_timestamp``;
3. derive the topic (alphanumerics of ``type`` + ``event``, then
   ``_00_raw_flatJSON``) and the partition key;
4. split off dead letters with a ``reason`` and their raw ``value`` (the
   reference rejected such requests with an error);
5. only where the flat record is wanted (``flat``): flatten nested objects and
   arrays to one level, names joined by ``_``, array items by index (``a_0``,
   ``a_1``...). Any depth, any width, any key is kept; numbers keep their exact
   text. When two paths flatten to one name, the later in document order wins.
   This step is a small Arrow-batched Python function: a tree of unknown depth
   has no fixed set of columns, so the flat record is one JSON string.

A routed or declared field may be written nested or partly flat
(``properties.shoppable_post_id``, ``properties_shoppable_post_id``...); where one
document has several of them, the one with the most levels wins. A field below an
empty key is kept in the flat record only. Numbers that are not whole are routed
by value, not by their text. The same code serves batch and streams.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedrank.session import ship_package

# Fixed values of the ingest step.
TOPIC_SUFFIX = "_00_raw_flatJSON"
POST_KEYED_EVENTS = ("Viewed Shoppable Fit", "Created Story")
USER_KEYED_EVENTS = ("Assigned AB Test Shard",)
ISO_UTC_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}Z$"
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"
CLICK_TOPIC = "trackViewedShoppableFit" + TOPIC_SUFFIX
CREATE_POST_TOPIC = "trackCreatedStory" + TOPIC_SUFFIX
STAMPS = ("segment_timestamp", "ingest_timestamp")

ROUTED = ("type", "event", "timestamp", "userId", "properties_shoppable_post_id")
END = "#end"                    # name of the field that closes a wrapped document
# Plain JSON only, at any depth and length.
JSON_OPTIONS = {"maxNestingDepth": "2147483647", "maxStringLen": "2147483647",
                "maxNumLen": "2147483647", "allowSingleQuotes": "false",
                "allowNonNumericNumbers": "false"}
JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}:,]|[^\s\[\]{}:,"]+', re.DOTALL)


# --------------------------------------------------------------------------
# parse and flatten
# --------------------------------------------------------------------------

class _Number(str):
    """A JSON number as its own text."""


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def flatten_value(doc: dict) -> dict:
    """One level of names for a parsed object; empty containers stay as values."""
    out: dict = {}
    stack = [iter([("", doc)])]
    while stack:
        try:
            name, value = next(stack[-1])
        except StopIteration:
            stack.pop()
            continue
        prefix = name + "_" if name else ""
        if isinstance(value, dict) and value:
            stack.append(iter([(prefix + k, v) for k, v in value.items()]))
        elif isinstance(value, list) and value:
            stack.append(iter([(f"{prefix}{i}", v) for i, v in enumerate(value)]))
        else:
            out.pop(name, None)
            out[name] = value
    return out


def flatten_deep(text: str) -> dict:
    """As :func:`flatten_value` from the text of a valid object of any depth."""
    out: dict = {}
    stack: list[list] = []          # name prefix, key of a value (None: next is a key), items
    for token in JSON_TOKEN.findall(text):
        if token in "{[":
            name = _name(stack)
            stack.append([name, None if token == "{" else 0, 0, token])
        elif token in "}]":
            name, _, items, kind = stack.pop()
            if not items:
                out.pop(name, None)
                out[name] = {} if kind == "{" else []
        elif token == ",":
            stack[-1][1] = None if stack[-1][3] == "{" else stack[-1][1] + 1
        elif token != ":":
            if stack[-1][1] is None:
                stack[-1][1], stack[-1][2] = json.loads(token), 1
                continue
            name = _name(stack)
            out.pop(name, None)
            out[name] = json.loads(token, parse_int=_Number, parse_float=_Number)
    return out


def _name(stack: list[list]) -> str:
    """Flat name of the value that comes next; marks its container as not empty."""
    if not stack:
        return ""
    stack[-1][2] = 1
    prefix, key = stack[-1][0], stack[-1][1]
    return f"{prefix}_{key}" if prefix else str(key)


def _dump(flat: dict) -> str:
    def pair(k, v, ascii_only: bool) -> str:
        leaf = str(v) if isinstance(v, _Number) else json.dumps(v, ensure_ascii=ascii_only)
        return f"{json.dumps(k, ensure_ascii=ascii_only)}:{leaf}"

    text = "{" + ",".join([pair(k, v, False) for k, v in flat.items()]) + "}"
    try:
        text.encode("utf-8")
    except UnicodeEncodeError:
        text = "{" + ",".join([pair(k, v, True) for k, v in flat.items()]) + "}"
    return text


def flat_document(value: str | None) -> str | None:
    """The flat record of a raw document; null where it is no JSON object."""
    try:
        doc = json.loads(value or "", parse_int=_Number, parse_float=_Number,
                         parse_constant=_no_constant)
        if not isinstance(doc, dict):
            return None
        flat = flatten_value(doc)
    except RecursionError:
        try:
            flat = flatten_deep(value) if value.lstrip().startswith("{") else None
        except (ValueError, IndexError, TypeError):     # no JSON, as ``problem`` tells
            flat = None
        if flat is None:
            return None
    except ValueError:
        return None
    for name in STAMPS:
        flat.pop(name, None)                                     # set by the ingest step
    return _dump(flat)


def _flat_batch(values: pd.Series) -> pd.Series:
    return pd.Series([flat_document(v) for v in values], dtype=object)


# Not to be pushed below or repeated in filters: one parse a document.
_flat_udf = F.pandas_udf(_flat_batch, T.StringType()).asNondeterministic()


# --------------------------------------------------------------------------
# routed and declared fields, by path
# --------------------------------------------------------------------------

def paths_of(name: str) -> list[tuple[str, ...]]:
    """The ways to write a flat name as nested keys, most levels first.

    >>> paths_of("a_b")
    [('a', 'b'), ('a_b',)]
    """
    words = name.split("_")
    found = [(words[0],)]
    for word in words[1:]:
        found = [p for q in found for p in ((*q, word), (*q[:-1], f"{q[-1]}_{word}"))]
    return sorted(found, key=len, reverse=True)


def _path_schema(names: tuple[str, ...]) -> T.StructType:
    tree: dict = {}
    for name in names:
        for *above, last in paths_of(name):
            node = tree
            for key in above:
                node = node.setdefault(key, {})
            node.setdefault(last, None)
            if node[last] is not None:
                raise ValueError(f"{name} is also the start of another field")

    def struct(node: dict) -> T.StructType:
        return T.StructType([T.StructField(k, T.VariantType() if v is None else struct(v))
                             for k, v in node.items()])

    return struct(tree)


def _variant(document: Column, path: tuple[str, ...]) -> Column:
    for key in path:
        document = document.getField(key)
    return document


def _as_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _is_leaf(v: Column) -> Column:
    """Not null, nor a container whose items flatten to other names."""
    text = _as_text(v)
    return ~F.is_variant_null(v) & (~F.substring(text, 1, 1).isin("{", "[")
                                    | text.isin("{}", "[]")
                                    | (F.schema_of_variant(v) == "STRING"))


def _once(df: DataFrame, keep: list[str], **structs: Column) -> DataFrame:
    """``keep`` and new columns. The explode of one item is a barrier: filters and
    projections above it don't repeat what is computed here."""
    made = F.struct(*[c.alias(n) for n, c in structs.items()])
    return df.select(*keep, F.explode(F.array(made)).alias("_made")).select(
        *keep, *[F.col("_made").getField(n).alias(n) for n in structs])


def leaves(df: DataFrame, keep: list[str], document: Column, names: tuple[str, ...]) -> DataFrame:
    """``keep`` and, per field, a column ``_<name>`` with its ``kind`` and ``text``,
    both null where it is absent or null. Kinds: STRING, BIGINT, DECIMAL(p,s), DOUBLE..."""
    def first(name: str) -> Column:
        # a higher-order function: its body is compiled once, not once a path
        found = F.array(*[_variant(F.col("_root"), p) for p in paths_of(name)])
        return F.try_element_at(F.filter(found, lambda v: v.isNotNull() & _is_leaf(v)), F.lit(1))

    df = _once(df, keep, _root=document)
    df = _once(df, keep, **{f"_{n}": first(n) for n in names})
    return _once(df, keep, **{f"_{n}": F.struct(
        F.schema_of_variant(f"_{n}").alias("kind"), _as_text(F.col(f"_{n}")).alias("text"))
        for n in names})


def _wrapped(names: tuple[str, ...], value: Column) -> Column:
    """The document and a closing element as parsed by one ``from_json``.

    The closing element bears a hash of the document, so text behind the end of
    the document can't pass for it.
    """
    schema = T.ArrayType(_path_schema(names).add(END, T.StringType()))
    text = F.concat(F.lit("["), value, F.lit(f',{{"{END}":"'), _mark(value), F.lit('"}]'))
    return F.from_json(text, schema, JSON_OPTIONS)


def _mark(value: Column) -> Column:
    return F.xxhash64(value).cast("string")


def _closed(elements: Column, value: Column, n: int) -> Column:
    """Whether the wrapped text was JSON of n elements, the last its closing one."""
    return F.coalesce((F.size(elements) == n)
                      & (F.try_element_at(elements, F.lit(n)).getField(END) == _mark(value)),
                      F.lit(False))


def _is_json(value: Column) -> Column:
    """Whether any JSON value (object or not) is valid: it must be one both as a
    member and as an array's only item, which no list of several values is."""
    text = F.concat(F.lit('[{"v":'), value, F.lit('},{"v":['), value,
                    F.lit(f']}},{{"{END}":"'), _mark(value), F.lit('"}]'))
    schema = T.ArrayType(T.StructType([T.StructField(END, T.StringType())]))
    return _closed(F.from_json(text, schema, JSON_OPTIONS), value, 3)


def _whole(kind: Column, text: Column) -> Column:
    """An integer's decimal text, from whole strings and from numbers cut towards zero."""
    digits = F.regexp_extract(text, r"(?U)^\s*[+-]?0*([0-9]+)\s*$", 1)
    minus = text.rlike(r"(?U)^\s*-") & (digits != "0")
    string = F.when(digits != "", F.concat(F.when(minus, "-").otherwise(""), digits))
    real = text.try_cast("double")
    plain = F.when(F.abs(real) < 2.0 ** 63, real.try_cast("long").cast("string")).otherwise(
        F.regexp_extract(F.regexp_replace(F.format_number(real, 0), ",", ""), "^-?[0-9]+$", 0))
    cut = F.regexp_replace(F.regexp_extract(text, "^-?[0-9]+", 0), "^-0$", "0")
    return (F.when(kind == "STRING", string)
             .when(kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL)"), cut)
             .when(kind.isin("DOUBLE", "FLOAT"), F.nullif(plain, F.lit(""))))


def parse(raw: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, the raw ``value``, ``problem`` (null for JSON objects), the routed
    fields (``type``, ``event``, ``timestamp``, ``post_id``, ``has_post_id``, ``user_id``)
    and the flat record ``flat``, which costs nothing unless it is read."""
    ship_package(raw.sparkSession)
    keep = keep if keep is not None else [c for c in raw.columns if c != value_col]
    text = F.coalesce(F.col("value"), F.lit(""))
    read = _once(raw.select(*keep, F.col(value_col).alias("value")), [*keep, "value"],
                 _doc=_wrapped(ROUTED, text))
    is_object = text.rlike(r"^[ \t\r\n]*\{")
    problem = (F.when(is_object, F.when(~_closed(F.col("_doc"), text, 2), "invalid_json"))
               .when(_is_json(text), "not_an_object").otherwise("invalid_json"))
    found = leaves(read.withColumn("problem", problem), [*keep, "value", "problem"],
                   F.try_element_at("_doc", F.lit(1)), ROUTED)

    def string(name: str) -> Column:
        return F.when(F.col(f"_{name}.kind") == "STRING", F.col(f"_{name}.text"))

    post, user = F.col("_properties_shoppable_post_id"), F.col("_userId")
    whole = {n: string(n) for n in ("type", "event", "timestamp")} | {
        "post_id": _whole(post["kind"], post["text"]), "has_post_id": post["kind"].isNotNull(),
        "user_id": F.when(user["kind"].rlike("^(STRING|TINYINT|SMALLINT|INT|BIGINT|DECIMAL|DOUBLE|FLOAT)"),
                          user["text"])}
    return _once(found, [*keep, "value", "problem"], **whole).withColumn(
        "flat", _flat_udf(F.col("value")))


def flat_fields(ingested: DataFrame, schema: str, keep: list[str] | None = None) -> DataFrame:
    """Typed columns of the flat record (DDL ``schema``); others stay unread."""
    return _typed(ingested, "flat", T._parse_datatype_string(schema), keep or [])


def _typed(df: DataFrame, column: str, schema: T.StructType, keep: list[str]) -> DataFrame:
    # Read as text first: a number sent as a string still casts.
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return (df.select(*keep, F.from_json(column, texts).alias("_r"))
            .select(*keep, *[F.col("_r").getField(f.name).try_cast(f.dataType).alias(f.name)
                             for f in schema.fields]))


# --------------------------------------------------------------------------
# time, topic, key
# --------------------------------------------------------------------------

def iso_to_epoch_millis(s: Column) -> Column:
    """ISO-8601 UTC string (1-6 fraction digits, ``Z``) -> epoch ms; null if bad."""
    ok = s.rlike(ISO_UTC_PATTERN)
    ts = F.try_to_timestamp(s, F.lit(ISO_UTC_FORMAT))
    return F.when(ok, F.unix_millis(ts))


def topic_of(type_col: Column, event_col: Column) -> Column:
    """Alphanumerics of type + event, then the suffix; null if either is null."""
    return F.concat(F.regexp_replace(F.concat(type_col, event_col), r"[^\p{L}\p{N}]", ""),
                    F.lit(TOPIC_SUFFIX))


def key_of(event_col: Column, post_id_col: Column, user_id_col: Column) -> Column:
    """Partition key as a string: post id, user id, or ``0``."""
    return (F.when(event_col.isin(*POST_KEYED_EVENTS), post_id_col)
             .when(event_col.isin(*USER_KEYED_EVENTS), user_id_col)
             .otherwise(F.lit("0")))


def reason_of() -> Column:
    """Dead-letter reason of a parsed document, null when it is valid."""
    posts = F.col("event").isin(*POST_KEYED_EVENTS)
    return (F.when(F.col("problem").isNotNull(), F.col("problem"))
             .when(F.col("type").isNull() | F.col("event").isNull(), F.lit("missing_type_or_event"))
             .when(iso_to_epoch_millis(F.col("timestamp")).isNull(), F.lit("bad_timestamp"))
             .when(posts & ~F.col("has_post_id"), F.lit("missing_post_id"))
             .when(posts & F.col("post_id").isNull(), F.lit("bad_post_id"))
             .when(F.col("event").isin(*USER_KEYED_EVENTS) & F.col("user_id").isNull(),
                   F.lit("missing_user_id")))


def ingest(raw: DataFrame, ingest_ts_ms: Column | int, value_col: str = "value",
           keep: list[str] | None = None) -> DataFrame:
    """Raw documents -> flat records with segment/ingest time, topic, key, reason.

    ``ingest_ts_ms``: the ingest stamp (``unix_millis(current_timestamp())`` in a
    live job; a literal in tests).
    """
    keep = keep if keep is not None else [c for c in raw.columns if c != value_col]
    stamp = ingest_ts_ms if isinstance(ingest_ts_ms, Column) else F.lit(int(ingest_ts_ms))
    return parse(raw, value_col, keep).select(
        *keep, "value", "flat", "type", "event", "timestamp",
        iso_to_epoch_millis(F.col("timestamp")).alias("segment_timestamp"),
        stamp.cast("long").alias("ingest_timestamp"),
        topic_of(F.col("type"), F.col("event")).alias("topic"),
        key_of(F.col("event"), F.col("post_id"), F.col("user_id")).alias("key"),
        reason_of().alias("reason"))


def records(ingested: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Valid records as (topic, key, value JSON) ready for a file or Kafka sink."""
    stamps = F.concat(*[x for n in STAMPS for x in (F.lit(f',"{n}":'), F.col(n).cast("string"))])
    body = F.expr("substring(flat, 1, length(flat) - 1)")
    return (ingested.filter(F.col("reason").isNull())
            .select(*(keep or []), "topic", "key",
                    F.concat(body, stamps, F.lit("}")).alias("value")))


def dead_letters(ingested: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rejected documents: ``keep`` columns, the raw ``value`` and the ``reason``."""
    return (ingested.filter(F.col("reason").isNotNull())
            .select(*(keep or []), "value", "reason"))


def scan_declared(ingested: DataFrame, topic: str, schema: T.StructType,
                  keep: list[str] | None = None) -> DataFrame:
    """As :func:`scan_topic`, straight from the ingested documents.

    Only the declared fields are read from the raw text, as column expressions;
    no flat record is built.
    """
    stamped = [f.name for f in schema.fields if f.name in STAMPS]
    names = tuple(f.name for f in schema.fields if f.name not in STAMPS)
    rows = ingested.filter(F.col("reason").isNull() & (F.col("topic") == topic))
    kept = [*(keep or []), *stamped]
    read = leaves(_once(rows, kept, _doc=F.from_json("value", _path_schema(names), JSON_OPTIONS)),
                  kept, F.col("_doc"), names)
    return read.select(*(keep or []), *[
        (F.col(f.name) if f.name in STAMPS else F.col(f"_{f.name}.text"))
        .try_cast(f.dataType).alias(f.name) for f in schema.fields])


def scan_topic(routed: DataFrame, topic: str, schema: T.StructType) -> DataFrame:
    """Declared-schema scan of one topic: only the declared fields are read."""
    return _typed(routed.filter(F.col("topic") == topic), "value", schema, [])
