"""Readers for curated targets, collections, subjects and harvest state."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.encoder import encode_basestring_ascii

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DOCUMENT, TARGET


def read_targets(spark: SparkSession, path: str, schema: T.StructType = TARGET) -> DataFrame:
    """Target feed: a ``.json`` array or a ``.jsonl`` file."""
    if path.endswith(".json"):
        return spark.read.schema(schema).json(path, multiLine=True)
    if path.endswith(".jsonl"):
        return spark.read.schema(schema).json(path)
    raise ValueError(f"cannot tell the format of {path}: .json or .jsonl expected")


_COLLECTION = "struct<id:bigint,parent_id:bigint,name:string,publish:boolean,start_date:string,end_date:string,target_ids:array<bigint>>"
_SUBJECT = "struct<id:bigint,parent_id:bigint,name:string,publish:boolean>"


def read_curation(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Curation export (maps keyed by id) to targets, collections,
    (collection_id, target_id) pairs and subjects. Trees come as parent_id."""
    schema = f"targets map<string,{TARGET.simpleString()}>, collections map<string,{_COLLECTION}>, subjects map<string,{_SUBJECT}>"
    doc = spark.read.schema(schema).json(path, multiLine=True)

    def rows(name: str) -> DataFrame:
        return doc.select(F.explode(name).alias("key", "v")).select("v.*")

    collections = rows("collections")
    pairs = collections.select(F.col("id").alias("collection_id"), F.explode("target_ids").alias("target_id"))
    return rows("targets"), collections.drop("target_ids"), pairs, rows("subjects")


class _Number(str):
    """A number with a fraction or exponent as it was written."""


def _object(pairs: list) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        raise ValueError(f"a name comes twice in one object: {[k for k, _ in pairs][:20]}")
    return found


def _no_number(text: str) -> None:
    raise ValueError(f"{text} is no JSON")


_READER = json.JSONDecoder(object_pairs_hook=_object, parse_float=_Number, parse_constant=_no_number)


def _text(value: object) -> str:
    if isinstance(value, _Number):
        return value
    if isinstance(value, str):
        return encode_basestring_ascii(value)
    if isinstance(value, dict):
        return "{" + ",".join([f"{encode_basestring_ascii(k)}:{_text(v)}" for k, v in value.items()]) + "}"
    if isinstance(value, list):
        return "[" + ",".join([_text(v) for v in value]) + "]"
    return "null" if value is None else "true" if value is True else "false" if value is False else str(value)


def _plain(value: object, kind: str) -> bool:
    """Whether a value is one of its column as it is, so that no cast is needed."""
    if value is None:
        return kind in _PLAIN
    if kind == "bigint":
        return type(value) is int and -(1 << 63) <= value < 1 << 63
    return kind == "string" and type(value) is str and (value.isascii() or not re.search("[\ud800-\udfff]", value))


_PLAIN = {"bigint": pa.int64(), "string": pa.string()}

#: Nodes that a task hands on at once.
_NODES = 10_000


def _walk(batches: Iterator[pa.RecordBatch], types: dict[str, str], children: str) -> Iterator[pa.RecordBatch]:
    """Rows of nodes: depth, the node without its children and its parent's id as JSON text where a
    value needs a cast, then the parent's id and the fields as they are, as far as they need none."""
    kinds = [types["id"], *types.values()]
    schema = pa.schema([("depth", pa.int32()), ("node", pa.string()), ("parent", pa.string()), *[(f"v{i}", _PLAIN.get(k, pa.null())) for i, k in enumerate(kinds)]])
    # A name with signs of a path is looked up as one.
    fields = [(n, "" if re.search(r"[.\[]", n) or k not in _PLAIN else k) for n, k in types.items()]
    found: list = []

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), schema)], schema=schema)
        found.clear()
        return out

    for text in (text.as_py() for batch in batches for text in batch.column(0)):
        tree = None if text is None else _READER.raw_decode(text, len(text) - len(text.lstrip(" \t\r\n")))[0]
        open_nodes = [(node, None, None, 0) for node in reversed(tree if isinstance(tree, list) else [tree])]
        while open_nodes:
            node, parent, number, depth = open_nodes.pop()
            if len(found) == _NODES:
                yield rows()
            if not isinstance(node, dict):
                found.append((depth, None if all(k for _, k in fields) else "null", parent, number, *[None] * len(fields)))
                continue
            values = [node.get(n) for n, _ in fields]
            if all(_plain(v, k) for v, (_, k) in zip(values, fields)):
                found.append((depth, None, parent, number, *values))
            else:
                kept = node if children in types else {k: v for k, v in node.items() if k != children}
                found.append((depth, _text(kept), parent, number, *[None] * len(fields)))
            inner = node.get(children)
            if inner is not None and not isinstance(inner, list):
                raise ValueError(f"{children} is no list: {_text(inner)[:200]}")
            if inner:
                own = node.get("id")
                above = (None, own) if _plain(own, types["id"]) else (_text(own), None)
                open_nodes += [(x, *above, depth + 1) for x in reversed(inner)]
    if found:
        yield rows()


def flatten_tree(trees: DataFrame, fields: str, tree: str = "tree", children: str = "children") -> DataFrame:
    """(id, parent_id, depth, fields...) of the nodes of nested JSON, however deep.

    ``tree`` holds a node or a list of nodes as text; ``fields`` is a schema like
    "id long, name string". A text is walked once, so no depth has to be known and
    nothing is stored; nodes with values that need a cast are read as variants.
    Text that is no JSON is an error.
    """
    types = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(fields)}
    kinds = [types["id"], *types.values()]
    schema = ", ".join(["depth int, node string, parent string", *[f"v{i} {k if k in _PLAIN else 'void'}" for i, k in enumerate(kinds)]])
    nodes = trees.select(F.col(tree).cast("string")).mapInArrow(lambda batches: _walk(batches, types, children), schema)
    nodes = nodes.withColumns({"node": F.parse_json("node"), "parent": F.parse_json("parent")})

    def value(i: int, whole: str, path: str) -> Column:
        return F.when(F.col(whole).isNull(), F.col(f"v{i}").cast(kinds[i])).otherwise(F.variant_get(whole, path, kinds[i]))

    return nodes.select(*[value(i, "node", f"$.{n}").alias(n) for i, n in enumerate(types, 1)], value(0, "parent", "$").alias("parent_id"), "depth")


def read_harvest_state(spark: SparkSession, folder: str) -> DataFrame:
    """Older harvest folders ``documents-*`` of one-JSON files as documents."""
    docs = spark.read.schema(DOCUMENT).json(f"{folder}/documents-*/*", multiLine=True)
    return docs.withColumn("status", F.coalesce("status", F.lit("NEW")))


def read_har(spark: SparkSession, path: str) -> DataFrame:
    from ..schemas import HAR

    return spark.read.schema(HAR).json(path, multiLine=True)
