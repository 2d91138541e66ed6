"""Markup to rows: one article becomes an array of nodes that Spark expressions work on."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.operators.documents import BLOCKS
NODE = ("struct<pos:int,stop:int,parent:int,depth:int,shield:int,secs:int,tag:string,attrs:map<string,string>,"
        "text:string,tail:string,start:int,length:int>")
SHRED = f"nodes array<{NODE}>, plain string"


def _local(name: str) -> str:
    return name.rsplit("}", 1)[-1]


def _shred_one(xml: str, out: list[list]) -> str | None:
    """Append one article's nodes, in document order, to the field lists of `out`; returns its plain text.

    `stop` is the position of a node's last descendant, `shield` that of its outermost block ancestor (-1: none), `secs` the
    number of sections around it;
    `start`/`length` delimit its text inside the plain text. Markup that does not parse gives None.
    """
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return None
    pos_, stop_, parent_, depth_, shield_, secs_, tag_, attrs_, text_, tail_, start_, length_ = out
    base, plain, size = len(pos_), [], 0
    stack = [(root, -1, 0, -1, 0, None)]
    while stack:
        el, parent, depth, shield, secs, done = stack.pop()
        if done is not None:
            stop_[base + done] = len(pos_) - base - 1
            length_[base + done] = size - start_[base + done]
            if depth and el.tail:
                plain.append(el.tail)
                size += len(el.tail)
            continue
        pos, tag = len(pos_) - base, _local(el.tag) if isinstance(el.tag, str) else "#"
        row = (pos, pos, parent, depth, shield, secs, tag, [(_local(k), v) for k, v in el.attrib.items()],
               el.text or "", (el.tail or "") if depth else "", size, 0)
        for column, value in zip(out, row):
            column.append(value)
        if el.text:
            plain.append(el.text)
            size += len(el.text)
        inner = pos if shield < 0 and tag in BLOCKS else shield
        stack.append((el, parent, depth, shield, secs, pos))
        stack.extend((c, pos, depth + 1, inner, secs + (tag == "sec"), None) for c in reversed(el))
    return "".join(plain)


_INT, _STR = pa.int32(), pa.string()
_FIELDS = [("pos", _INT), ("stop", _INT), ("parent", _INT), ("depth", _INT), ("shield", _INT), ("secs", _INT), ("tag", _STR),
           ("attrs", pa.map_(_STR, _STR)), ("text", _STR), ("tail", _STR), ("start", _INT), ("length", _INT)]


def _shred_batch(texts: list) -> tuple[pa.Array, pa.Array]:
    """Node lists and plain texts of some articles as Arrow arrays, without a Python object per nested value."""
    out: list[list] = [[] for _ in _FIELDS]
    offsets, plains = [], []
    for x in texts:
        at = len(out[0])
        plain = _shred_one(x, out) if isinstance(x, str) else None
        offsets.append(at if plain is not None else None)
        plains.append(plain)
    flat = pa.StructArray.from_arrays([pa.array(v, t) for v, (_, t) in zip(out, _FIELDS)], [n for n, _ in _FIELDS])
    ends = pa.array(offsets + [len(out[0])], pa.int32())
    return pa.ListArray.from_arrays(ends, flat), pa.array(plains, _STR)


def shred(docs: DataFrame, column: str = "xml", rows_at_once: int = 128, partitions: int | None = None) -> DataFrame:
    """`docs` with `nodes` and `plain` in place of the markup column; NULL where it does not parse.

    `partitions` deals the articles out first, for inputs with fewer splits than cores.
    """
    keep = [f for f in docs.schema.fields if f.name != column]
    names = [f.name for f in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [SHRED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, rows_at_once):
                part = b.slice(at, rows_at_once)
                nodes, plain = _shred_batch(part.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [nodes, plain], names + ["nodes", "plain"])

    source = docs.select(*names, column)
    return (source.repartition(partitions) if partitions else source).mapInArrow(run, schema)


def read_articles(spark: SparkSession, folder: str) -> DataFrame:
    """(path, xml) of every `.xml` file below a folder."""
    return (spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.xml").load(folder)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("xml")))


def shard_path(pmc_id, root: str = "data/db"):
    """Sharded path of an article: the first five characters of its id name the folder."""
    tag = F.when(pmc_id.startswith("PMC"), pmc_id).otherwise(F.concat(F.lit("PMC"), pmc_id))
    return F.concat_ws("/", F.lit(root), F.left(tag, F.lit(5)), F.concat(tag, F.lit(".xml")))
