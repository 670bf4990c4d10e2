"""Deeply nested records into flat relations by shared inlining of the schema graph.

The schema is read as a graph. A singleton struct is inlined into its parent, unless it owns
repeated children, which then need a row to name. Repeated elements (arrays and maps) become
relations. An element type reached from several parents is shared: ``shared`` finds such types
by comparing them, and their relations form one table whose rows name the parent's relation and
the element they came as. Recursive types cannot occur in a Spark schema; JSON text is parsed
into a fixed schema first.

Every child row names itself and its parent by the path of positions from the record.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Relation:
    """A node of the schema graph that gets its own table."""

    name: str
    step: tuple[str, ...]  # fields from the parent's value to this collection or struct
    kind: str  # array, map or struct
    type: T.DataType  # of one element
    parent: "Relation | None" = None
    children: list["Relation"] = field(default_factory=list)

    def walk(self):
        yield self
        for c in self.children:
            yield from c.walk()


def _owns_repeated(t: T.DataType) -> bool:
    return isinstance(t, T.StructType) and any(isinstance(f.dataType, (T.ArrayType, T.MapType)) and not _flat(f.dataType) or _owns_repeated(f.dataType) for f in t.fields)


def _flat(t: T.DataType) -> bool:
    """Collections of plain values stay inlined as one column, like any other value."""
    return isinstance(t, T.ArrayType) and not isinstance(t.elementType, (T.StructType, T.ArrayType, T.MapType))


def _children(parent: Relation, t: T.DataType, step: tuple[str, ...], names: dict[str, str], inline_maps: set[str]) -> list[Relation]:
    out: list[Relation] = []
    if not isinstance(t, T.StructType):
        return out
    for f in t.fields:
        here, d = step + (f.name,), f.dataType
        label = names.get(f"{parent.name}.{f.name}", names.get(f.name, f.name))
        if isinstance(d, T.ArrayType) and not _flat(d):
            r = Relation(label, here, "array", d.elementType, parent)
        elif isinstance(d, T.MapType) and f.name not in inline_maps:
            r = Relation(label, here, "map", d.valueType, parent)
        elif isinstance(d, T.StructType) and _owns_repeated(d):
            r = Relation(label, here, "struct", d, parent)
        else:
            if isinstance(d, T.StructType):  # inlined singleton: its collections belong to the parent
                out += _children(parent, d, here, names, inline_maps)
            continue
        r.children = _children(r, r.type, (), names, inline_maps)
        out.append(r)
    return out


def schema_graph(t: T.DataType, root: str, names: dict[str, str] | None = None, inline_maps: set[str] = frozenset()) -> Relation:
    """The relations of a record whose repeated ``root`` column has type ``t``."""
    top = Relation((names or {}).get(root, root), (root,), "array", t.elementType)
    top.children = _children(top, top.type, (), names or {}, set(inline_maps))
    return top


def shared(graph: Relation) -> dict[str, list[Relation]]:
    """table -> relations, for every table: elements of one struct type, whatever their parents, share the first's table.

    Types are equal if their fields have the same names and types in the same order.
    """
    tables: dict[str, list[Relation]] = {}
    by_type: dict[str, str] = {}
    for rel in graph.walk():
        kind = rel.type.simpleString() if isinstance(rel.type, T.StructType) and rel.kind != "struct" else f"{rel.name}:"
        name = by_type.setdefault(kind, rel.name)
        tables.setdefault(name, []).append(rel)
    return tables


def _get(v: Column, step: tuple[str, ...]) -> Column:
    for s in step:
        v = v[s]
    return v


def _rows(rel: Relation, value: Column, path: Column | None) -> Column:
    """array<struct<node, path, parent>> of all rows under ``rel`` in ``value``; null elements give none."""
    item = lambda p: F.struct(F.lit(rel.name).alias("node"), p.alias("path"), (path if path is not None else F.lit(None).cast("string")).alias("parent"))

    def below(v: Column, p: Column) -> Column:
        own = F.array(item(p))
        parts = [_rows(c, v, p) for c in rel.children]
        return F.concat(own, *parts) if parts else own

    empty = F.array().cast("array<struct<node:string,path:string,parent:string>>")
    got = _get(value, rel.step)
    join = lambda p, k: F.concat_ws(".", p, k) if p is not None else k
    if rel.kind == "struct":
        return F.when(got.isNull(), empty).otherwise(below(got, path))
    if rel.kind == "map":
        nested = F.transform(F.map_entries(got), lambda e: F.when(e["value"].isNull(), empty).otherwise(below(e["value"], join(path, e["key"].cast("string")))))
    else:
        nested = F.transform(got, lambda x, i: F.when(x.isNull(), empty).otherwise(below(x, join(path, i.cast("string")))))
    return F.coalesce(F.flatten(nested), empty)


def keys(df: DataFrame, key: str, graph: Relation) -> DataFrame:
    """(key, node, path, parent): the keys and foreign keys of all relations in one pass.

    ``parent`` is the parent row's path, null for rows of the record itself. Null or empty
    collections and null elements give no row, empty structs do. Records must be unique by key.
    """
    top = F.struct(F.col(graph.step[0]).alias(graph.step[0]))
    return df.select(F.col(key).alias("rec_id"), F.explode(_rows(graph, top, None)).alias("r")).select("rec_id", "r.node", "r.path", "r.parent")


def _inlined(t: T.DataType, v: Column, prefix: str = "") -> list[tuple[str, Column]]:
    """Own columns of a relation: values and inlined singletons, without child collections."""
    if not isinstance(t, T.StructType):
        return [("value", v)]
    out: list[tuple[str, Column]] = []
    for f in t.fields:
        name, d = f"{prefix}{f.name}", f.dataType
        if isinstance(d, T.StructType):
            out += _inlined(d, v[f.name], name + "_") if not _owns_repeated(d) else []
        elif not isinstance(d, (T.ArrayType, T.MapType)) or _flat(d):
            out.append((name, v[f.name]))
    return out


def relation(df: DataFrame, key: str, graph: Relation, name: str) -> DataFrame:
    """One typed relation: (rec_id, path, parent_node, parent, own columns...).

    Relations of the same name under several parents are unioned. The scan reads only the
    columns of this relation. Own columns that would clash with a key get a trailing underscore.
    """
    return _typed(df, key, graph, [rel for rel in graph.walk() if rel.name == name], False)


def relation_table(df: DataFrame, key: str, graph: Relation, name: str) -> DataFrame:
    """One table of ``shared``: (rec_id, node, path, parent_node, parent, own columns...), all relations of its type."""
    return _typed(df, key, graph, shared(graph).get(name, []), True)


def _typed(df: DataFrame, key: str, graph: Relation, relations: list[Relation], named: bool) -> DataFrame:
    out = None
    for rel in relations:
        chain, r = [], rel
        while r is not None:
            chain.insert(0, r)
            r = r.parent
        cur = df.select(F.col(key).alias("rec_id"), F.struct(F.col(graph.step[0]).alias(graph.step[0])).alias("v"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("parent"))
        for r in chain:
            got, before = _get(F.col("v"), r.step), F.col("path")
            if r.kind == "struct":
                cur = cur.where(got.isNotNull()).select("rec_id", got.alias("v"), "path", before.alias("parent"))
                continue
            gen = F.posexplode(got).alias("i", "x") if r.kind == "array" else F.explode(got).alias("i", "x")
            cur = cur.select("rec_id", "path", gen).where(F.col("x").isNotNull())
            cur = cur.select("rec_id", F.col("x").alias("v"), F.concat_ws(".", "path", F.col("i").cast("string")).alias("path"), F.col("path").alias("parent"))
        taken = {"rec_id", "path", "parent", "parent_node", "node"}
        own = [c.alias(n + "_" if n in taken else n) for n, c in _inlined(rel.type, F.col("v"))]
        part = cur.select("rec_id", *([F.lit(rel.name).alias("node")] if named else []), "path", F.lit(rel.parent.name if rel.parent else None).cast("string").alias("parent_node"), "parent", *own)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no such relation")
    return out
