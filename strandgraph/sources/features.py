"""Feature files: a value for each node as text, in a form that leaves out what the order of the lines implies.

A file has header lines ``@key=value``, an empty line, and a line for each value: ``nodes TAB value``, where nodes
is a list such as ``3,7-9``, or the value alone for the node after the last one named.  An empty line is an empty
value.  Tabs, line ends and backslashes in values are escaped by a backslash.

Writing cuts the nodes into parts of ``span`` numbers, a file each, so that no task holds a whole feature.
Null values have no line; a file without a body gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranges import islands

SPAN = 1 << 16


def escaped(value: Column) -> Column:
    pairs = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"))
    for plain, code in pairs:
        value = F.replace(value, F.lit(plain), F.lit(code))
    return value


def unescaped(value: Column) -> Column:
    """Escaped backslashes part the value, so that one before a t or an n isn't taken for theirs."""
    plain = lambda x: F.replace(F.replace(x, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n"))
    return F.array_join(F.transform(F.split(value, "\\\\\\\\"), plain), "\\")


def compact(values: DataFrame, span: int = SPAN) -> DataFrame:
    """part, first, line: a line for each value of a part, its nodes as ranges; ``values`` has node and value."""
    rows = values.where("node IS NOT NULL AND value IS NOT NULL").select("node", "value", F.floor(F.col("node") / span).cast("long").alias("part"))
    runs = islands(rows, ["part", "value"], "node")
    spec = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", F.col("lo").cast("string"), F.col("hi").cast("string")))
    grouped = runs.groupBy("part", "value").agg(F.min("lo").alias("first"), F.array_sort(F.collect_list(F.struct("lo", spec.alias("spec")))).alias("runs"))
    return grouped.select("part", "first", F.concat(F.array_join(F.col("runs.spec"), ","), F.lit("\t"), escaped(F.col("value"))).alias("line"))


def files(compacted: DataFrame, header: dict[str, str]) -> DataFrame:
    """part, content: the text of each part's file, lines in the order of their first nodes."""
    head = "".join(f"@{k}={v}\n" for k, v in header.items()) + "\n"
    lines = F.array_sort(F.collect_list(F.struct("first", "line"))).alias("lines")
    return compacted.groupBy("part").agg(lines).select("part", F.concat(F.lit(head), F.array_join(F.col("lines.line"), "\n"), F.lit("\n")).alias("content"))


def _body(contents: DataFrame, by: str) -> DataFrame:
    """by, at, line: the lines after the first empty one; the line end that closes the file adds none."""
    body = F.regexp_replace(F.substring_index(F.concat(F.lit("\n"), F.col("content")), "\n\n", 1), "^\n", "")
    after = F.substring("content", F.length(body) + 3, F.length("content"))
    return contents.withColumn("_rest", after).where("_rest <> ''").select(by, F.posexplode(F.split(F.regexp_replace("_rest", "\n\\z", ""), "\n", -1)).alias("at", "line"))


def _extents(spec: Column) -> Column:
    ends = lambda x: F.transform(F.split(F.trim(x), "-"), lambda e: e.cast("long"))
    pair = lambda x: F.named_struct(F.lit("lo"), F.array_min(ends(x)), F.lit("hi"), F.array_max(ends(x)))
    return F.transform(F.split(spec, ","), pair)


def read_nodes(contents: DataFrame, by: str = "part") -> DataFrame:
    """by, node, value of node features; ``contents`` has ``by`` and the whole text of a file as content."""
    tab = F.instr("line", "\t")
    rows = _body(contents, by).select(by, "at", F.when(tab > 0, _extents(F.substring_index("line", "\t", 1))).alias("named"), F.when(tab > 0, F.substring("line", tab + 1, F.length("line"))).otherwise(F.col("line")).alias("value"))
    order = Window.partitionBy(by).orderBy("at")
    rows = rows.withColumn("_n", F.row_number().over(order).cast("long"))
    known = F.when(F.col("named").isNotNull(), F.struct(F.array_max(F.col("named.hi")).alias("node"), F.col("_n").alias("n")))
    rows = rows.withColumn("_k", F.last(known, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    implied = F.coalesce(F.col("_k.node") + F.col("_n") - F.col("_k.n"), F.col("_n"))
    extents = F.coalesce("named", F.array(F.struct(implied.alias("lo"), implied.alias("hi"))))
    spread = rows.select(by, F.explode(extents).alias("e"), unescaped(F.col("value")).alias("value"))
    return spread.select(by, F.explode(F.sequence(F.col("e.lo"), F.col("e.hi"))).alias("node"), "value")


def read_edges(contents: DataFrame, by: str = "part", valued: bool = False) -> DataFrame:
    """by, src, dst, value of edge features.  A line is ``[sources TAB] targets [TAB value]``; without sources it
    belongs to the node after the last one; of a pair given twice the last line counts."""
    fields = F.split("line", "\t")
    n = F.size(fields)
    source = F.when(n == (3 if valued else 2), fields[0])
    target = F.when(n == 3, F.get(fields, F.lit(1))).otherwise(fields[0]) if valued else F.element_at(fields, -1)
    value = F.when(n > 1, unescaped(F.element_at(fields, -1))) if valued else F.lit(None).cast("string")
    rows = _body(contents, by).where("line <> ''").select(by, "at", source.alias("spec"), target.alias("to"), value.alias("value"))
    order = Window.partitionBy(by).orderBy("at")
    rows = rows.withColumn("_n", F.row_number().over(order).cast("long")).withColumn("named", F.when(F.col("spec").isNotNull(), _extents(F.col("spec"))))
    known = F.when(F.col("named").isNotNull(), F.struct(F.array_max(F.col("named.hi")).alias("node"), F.col("_n").alias("n")))
    rows = rows.withColumn("_k", F.last(known, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    implied = F.coalesce(F.col("_k.node") + F.col("_n") - F.col("_k.n"), F.col("_n"))
    both = rows.select(by, "at", "value", F.explode(F.coalesce("named", F.array(F.struct(implied.alias("lo"), implied.alias("hi"))))).alias("s"), _extents(F.col("to")).alias("t"))
    pairs = both.select(by, "at", "value", F.explode(F.sequence("s.lo", "s.hi")).alias("src"), "t")
    pairs = pairs.select(by, "at", "value", "src", F.explode("t").alias("e")).select(by, "at", "value", "src", F.explode(F.sequence("e.lo", "e.hi")).alias("dst"))
    return pairs.groupBy(by, "src", "dst").agg(F.max_by("value", "at").alias("value"))


def edge_lines(edges: DataFrame, valued: bool = False) -> DataFrame:
    """first, line of an edge file's body: sources, targets as ranges and the value, a line for each source and value."""
    keys = ["src", *(["value"] if valued else [])]
    runs = islands(edges, keys, "dst")
    spec = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", F.col("lo").cast("string"), F.col("hi").cast("string")))
    grouped = runs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lo", spec.alias("spec")))).alias("runs"))
    line = F.concat_ws("\t", F.col("src").cast("string"), F.array_join(F.col("runs.spec"), ","), *([escaped(F.coalesce("value", F.lit("")))] if valued else []))
    return grouped.select(F.col("src").alias("first"), line.alias("line"))
