"""Edits as data: rows of (record, path, value) applied to JSON records of any shape.

Only what lies on an edited path is taken apart: level by level the containers on the way give
their children, everything else stays one value.  Edited values replace children (or join them), and
the containers are put together again from the deepest level up.  The edits of a record are brought
to it by one join, and its levels are folds over arrays within its row.  Folds compare each edit
with each, so a record with more than ``MANY`` edits is taken apart into rows instead, by joins keyed
by record and path.

A path is ``a.b[0].c``.  What it lacks on the way is created as an object; an index beyond the end
of a list fills it up with nulls; a name set on a list has no effect.  Edits of one record apply in
the order of ``seq``.  A record stays as it was, and gets a note in ``edit_problem``, when a path
leads through a value that is neither object nor list, when a later edit lies inside an edited
value, or when an index lies ``FARTHEST`` or more beyond the end.  Text that is not JSON counts as
an empty object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import bind, let
from rollcall.functions.variants import kind, parse_whole
from rollcall.operators.dedup import last_wins
from rollcall.plans.session import written

FARTHEST = 1000
DEEPEST = 64
MANY = 100                 # edits of one record
THROUGH = "a path leads through a value"
INSIDE = "an edit lies inside an edited value"
BEYOND = "an index lies too far beyond the end"
TOO_DEEP = "a path is too deep"


def path_parts(path: Column) -> Column:
    return F.split(F.regexp_replace(path, r"\[(\d+)\]", ".$1"), r"\.")


def form_value(text: Column, data_type: Column) -> Column:
    """JSON text of a form field: number, boolean, array-primitive (a comma list), or text."""
    number = F.when(F.trim(text) == "", 0.0).otherwise(F.trim(text).try_cast("double"))
    whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
    items = F.filter(F.transform(F.split(text, ","), lambda s: F.trim(s)), lambda s: s != "")
    return F.coalesce(
        F.when(data_type == "number", F.when(whole, number.cast("bigint").cast("string"))
               .otherwise(F.when(~F.isnan(number) & (F.abs(number) < float("inf")),
                                 number.cast("string"))))
        .when(data_type == "boolean", (text == "true").cast("string"))
        .when(data_type == "array-primitive", F.to_json(items))
        .otherwise(_quoted(text)), F.lit("null"))


def _quoted(text: Column) -> Column:
    """A JSON string."""
    return F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)


def _settled(last: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edits that count, problems) of the last edit of each path: without those another one covers."""
    shorter = F.transform(F.sequence(F.lit(1), F.size("path") - 1),
                          lambda n: F.slice(F.col("path"), F.lit(1), n))
    within = last.where(F.size("path") > 1).select(
        "_id", "path", "seq", F.explode(shorter).alias("above")).join(
        last.select("_id", F.col("path").alias("above"), F.col("seq").alias("then")),
        ["_id", "above"]).groupBy("_id", "path").agg(
        F.max("then").alias("then"), F.first("seq").alias("seq"))
    counted = last.join(within.select("_id", "path"), ["_id", "path"], "left_anti")
    deep = last.where(F.size("path") > DEEPEST).select("_id", F.lit(TOO_DEEP).alias("problem"))
    return counted, within.where("seq > then").select(
        "_id", F.lit(INSIDE).alias("problem")).union(deep)


def apply_edits(records: DataFrame, edits: DataFrame, keys: list[str],
                data: str = "data") -> DataFrame:
    """``records`` (unique ``keys``) after ``edits`` (keys, seq, path, data_type, value)."""
    asked = edits.select(
        F.struct(*keys).alias("_id"), path_parts(F.col("path")).alias("path"),
        form_value(F.col("value"), F.col("data_type")).alias("text"), "seq")
    listed = written(last_wins(asked, ["_id", "path"], "seq").groupBy("_id").agg(
        F.collect_list(F.struct("path", "text", "seq")).alias("_edits")), "edits")
    key = [F.col("_id")[k].alias(k) for k in keys]
    few = F.size("_edits") <= MANY
    root = F.coalesce(parse_whole(F.col(data)), F.parse_json(F.lit("{}")))
    met = bind(records.join(listed.where(few).select(*key, "_edits"), keys, "left"),
               F.when(F.col("_edits").isNotNull(), _edited(root, F.col("_edits"))),
               lambda r: {"_new": r["text"], "edit_problem": r["problem"]})
    if listed.where(~few).limit(1).count():
        many = listed.where(~few).select("_id", F.inline("_edits"))
        found = _edited_by_rows(records.select(F.struct(*keys).alias("_id"), root.alias("v")), many)
        met = met.join(found.select(*key, F.col("_new").alias("_far"), F.col("problem").alias("_p")),
                       keys, "left").withColumn("_new", F.coalesce("_new", "_far")).withColumn(
            "edit_problem", F.coalesce("edit_problem", "_p"))
    return met.withColumn(data, F.when(F.col("edit_problem").isNull(), F.coalesce("_new", data))
                          .otherwise(F.col(data))).select(*records.columns, "edit_problem")


def _edited(root: Column, edits: Column) -> Column:
    """struct(text, problem) of a VARIANT after the last edits (path, text, seq) of its paths."""
    def above(e: Column, every: Column) -> Column:
        return F.filter(every, lambda a: (F.size(a["path"]) < F.size(e["path"])) & (
            F.slice(e["path"], F.lit(1), F.size(a["path"])) == a["path"]))

    def settled(g: Column) -> Column:
        every = g["edits"]
        ranked = F.transform(every, lambda e: F.struct(
            e.alias("e"), F.transform(above(e, every), lambda a: a["seq"]).alias("above")))
        return let(ranked, lambda r: F.struct(
            g["v"].alias("v"),
            F.transform(F.filter(r, lambda x: (F.size(x["above"]) == 0)
                                 & (F.size(x["e"]["path"]) <= DEEPEST)), lambda x: x["e"]).alias("edits"),
            F.exists(r, lambda x: F.coalesce(x["e"]["seq"] > F.array_max(x["above"]), F.lit(False)))
            .alias("inside"),
            F.exists(every, lambda e: F.size(e["path"]) > DEEPEST).alias("deep")))

    def opened(g: Column) -> Column:
        levels = F.array_max(F.transform(g["edits"], lambda e: F.size(e["path"])))
        steps = F.sequence(F.lit(0), levels - 1)
        nodes = F.aggregate(
            steps, F.expr("cast(array() as array<struct<path:array<string>,kind:string,"
                          "kids:array<struct<key:string,value:variant>>>>)"),
            lambda found, i: F.concat(found, _opened(g["v"], g["edits"], found, i)))
        return F.struct(g["edits"].alias("edits"), F.reverse(steps).alias("steps"), nodes.alias("nodes"),
                        g["inside"].alias("inside"), g["deep"].alias("deep"))

    def built(g: Column) -> Column:
        none = F.expr("cast(struct(array(), false) as "
                      "struct<rows:array<struct<path:array<string>,text:string>>,beyond:boolean>)")
        done = F.aggregate(g["steps"], none, lambda b, i: let(
            _built(g["edits"], g["nodes"], b["rows"], i), lambda rows: F.struct(
                rows.alias("rows"), (b["beyond"] | F.exists(rows, lambda r: r["text"].isNull()))
                .alias("beyond"))))
        through = F.exists(g["nodes"], lambda n: ~n["kind"].isin("OBJECT", "ARRAY"))
        return let(done, lambda d: F.struct(
            F.get(d["rows"], F.lit(0))["text"].alias("text"),
            F.array_min(F.array(
                F.when(g["inside"], INSIDE), F.when(g["deep"], TOO_DEEP), F.when(through, THROUGH),
                F.when(d["beyond"], BEYOND))).alias("problem")))

    start = F.struct(root.alias("v"), edits.alias("edits"))
    return let(let(let(start, settled), opened), built)


def _opened(root: Column, edits: Column, above: Column, depth: Column) -> Column:
    """(path, kind, kids) of the containers of one depth on edited paths, from those above them."""
    on_way = F.array_distinct(F.transform(
        F.filter(edits, lambda e: F.size(e["path"]) > depth),
        lambda e: F.slice(e["path"], F.lit(1), depth)))

    def value(path: Column) -> Column:
        up = F.slice(path, F.lit(1), F.greatest(depth - 1, F.lit(0)))
        kids = F.get(F.filter(above, lambda n: n["path"] == up), F.lit(0))["kids"]
        return F.when(depth == 0, root).otherwise(F.get(
            F.filter(kids, lambda k: k["key"] == F.get(path, depth - 1)), F.lit(0))["value"])

    def kids(v: Column, k: Column) -> Column:
        fields = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
        items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, at: F.struct(
            at.cast("string").alias("key"), x.alias("value")))
        return F.coalesce(F.when(k == "OBJECT", fields).when(k == "ARRAY", items),
                          F.expr("cast(array() as array<struct<key:string,value:variant>>)"))

    def node(path: Column) -> Column:
        def of(v: Column) -> Column:
            return let(F.coalesce(kind(v), F.lit("OBJECT")), lambda k: F.struct(
                path.alias("path"), k.alias("kind"), kids(v, k).alias("kids")))

        return let(value(path), of)

    return F.transform(on_way, node)


def _built(edits: Column, nodes: Column, below: Column, depth: Column) -> Column:
    """(path, text) of the containers of one depth, from the edits and the containers below them."""
    def own(row: Column, path: Column) -> Column:
        return (F.size(row["path"]) == depth + 1) & (F.slice(row["path"], F.lit(1), depth) == path)

    def container(n: Column) -> Column:
        new = F.transform(F.concat(
            F.filter(F.transform(edits, lambda e: F.struct(e["path"].alias("path"), e["text"].alias("text"))),
                     lambda e: own(e, n["path"])),
            F.filter(below, lambda b: own(b, n["path"]))),
            lambda r: F.struct(F.get(r["path"], depth).alias("key"), r["text"].alias("text")))

        def put(changed: Column) -> Column:
            names = F.transform(changed, lambda c: c["key"])
            kept = F.transform(F.filter(n["kids"], lambda k: ~F.array_contains(names, k["key"])),
                               lambda k: F.struct(k["key"].alias("key"), F.to_json(k["value"]).alias("text")))
            return let(F.array_sort(F.concat(kept, changed)), lambda parts: F.struct(
                n["path"].alias("path"), _container(n["kind"], parts).alias("text")))

        return let(new, put)

    return F.transform(F.filter(nodes, lambda n: F.size(n["path"]) == depth), container)


def _edited_by_rows(roots: DataFrame, last: DataFrame) -> DataFrame:
    """(_id, _new, problem) of records (_id, v) with many edits (_id, path, text, seq)."""
    counted, problems = _settled(last)
    counted = written(counted.where(F.size("path") <= DEEPEST), "edits-counted")
    levels = counted.agg(F.max(F.size("path"))).first()[0] or 0
    nodes = roots.join(counted.select("_id").distinct(), "_id", "left_semi").select(
        "_id", F.expr("cast(array() as array<string>)").alias("path"), "v")
    opened = []
    for depth in range(levels):
        # --- take apart what lies on a path
        on_way = counted.where(F.size("path") > depth).select(
            "_id", F.slice("path", 1, depth).alias("path")).distinct()
        here = written(on_way.join(nodes, ["_id", "path"], "left").withColumn(
            "kind", F.coalesce(kind(F.col("v")), F.lit("OBJECT"))), "edits-opened")
        problems = problems.union(here.where(~F.col("kind").isin("OBJECT", "ARRAY")).select(
            "_id", F.lit(THROUGH).alias("problem")))
        fields = here.where("kind = 'OBJECT' and v is not null").select(
            "_id", "path", F.explode(F.try_variant_get("v", "$", "map<string,variant>"))
            .alias("key", "v"))
        items = here.where("kind = 'ARRAY'").select(
            "_id", "path", F.posexplode(F.try_variant_get("v", "$", "array<variant>"))
            .alias("at", "v")).select("_id", "path", F.col("at").cast("string").alias("key"), "v")
        children = fields.unionByName(items)
        nodes = children.select("_id", F.concat("path", F.array("key")).alias("path"), "v")
        opened.append((here.select("_id", "path", "kind"), children))
    built = None
    for depth in range(levels - 1, -1, -1):
        # --- put together: edited values before rebuilt containers before what was there
        here, children = opened[depth]
        up, key = F.slice("path", 1, depth), F.element_at("path", depth + 1)
        parts = children.select("_id", "path", "key", F.to_json("v").alias("text"),
                                F.lit(0).alias("rank"))
        parts = parts.unionByName(counted.where(F.size("path") == depth + 1).select(
            "_id", up.alias("path"), key.alias("key"), "text", F.lit(2).alias("rank")))
        if built is not None:
            parts = parts.unionByName(built.select(
                "_id", up.alias("path"), key.alias("key"), "text", F.lit(1).alias("rank")))
        newest = parts.groupBy("_id", "path", "key").agg(F.max_by("text", "rank").alias("text"))
        joined = here.join(newest.groupBy("_id", "path").agg(F.array_sort(F.collect_list(
            F.struct("key", "text"))).alias("parts")), ["_id", "path"], "left")
        built = written(joined.select("_id", "path", _container(F.col("kind"), F.col("parts")).alias("text")), "edits-built")
        problems = problems.union(built.where("text is null").select(
            "_id", F.lit(BEYOND).alias("problem")))
    noted = problems.groupBy("_id").agg(F.min("problem").alias("problem"))
    if built is None:
        return noted.select("_id", F.lit(None).cast("string").alias("_new"), "problem")
    return built.select("_id", F.col("text").alias("_new")).join(noted, "_id", "full")


def _container(kind_of: Column, parts: Column) -> Column:
    """JSON text of an object or list from its parts; null for a list with too wide a gap."""
    parts = F.coalesce(parts, F.expr("array()"))
    fields = F.transform(parts, lambda p: F.concat(_quoted(p["key"]), F.lit(":"), p["text"]))
    items = F.filter(F.transform(parts, lambda p: F.struct(
        p["key"].try_cast("int").alias("at"), p["text"].alias("text"))), lambda p: p["at"] >= 0)

    def listed(by_place: Column) -> Column:
        length = F.coalesce(F.array_max(F.map_keys(by_place)) + 1, F.lit(0))
        filled = F.when(length == 0, F.expr("cast(array() as array<string>)")).otherwise(F.transform(
            F.sequence(F.lit(0), length - 1),
            lambda i: F.coalesce(F.try_element_at(by_place, i), F.lit("null"))))
        return F.when(length < F.size(parts) + FARTHEST,
                      F.concat(F.lit("["), F.array_join(filled, ","), F.lit("]")))

    return F.when(kind_of == "ARRAY", let(F.map_from_entries(items), listed)).otherwise(
        F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}")))
