"""Template search: an indented list of ``type feature=value ...`` becomes a chain of joins.

Indentation means containment; a block between ``/without/`` and ``/-/`` is a negated container.  A predicate
is split at its first operator only, so values may hold further ``=`` signs.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buckets


@dataclass
class Atom:
    otype: str
    predicates: list[tuple[str, str, str]]
    children: list[Atom] = field(default_factory=list)
    without: list[Atom] = field(default_factory=list)


def parse(template: str) -> list[Atom]:
    roots: list[Atom] = []
    stack: list[tuple[int, Atom]] = []
    negated = False
    for raw in template.splitlines():
        if not raw.strip():
            continue
        depth, words = len(raw) - len(raw.lstrip()), raw.split()
        if words[0] in ("/without/", "/-/"):
            negated = words[0] == "/without/"
            continue
        predicates = []
        for w in words[1:]:
            m = re.match(r"([^=<>]+)([=<>])(.*)$", w)
            predicates.append((m[1], m[2], m[3]) if m else (w, "present", ""))
        atom = Atom(words[0], predicates)
        while stack and stack[-1][0] >= depth:
            stack.pop()
        if not stack:
            roots.append(atom)
        else:
            (stack[-1][1].without if negated else stack[-1][1].children).append(atom)
        stack.append((depth, atom))
    return roots


def _filter(df: DataFrame, predicates) -> DataFrame:
    for name, op, value in predicates:
        c = F.col(name)
        typed = F.lit(value).cast(df.schema[name].dataType) if op != "present" else None
        test: Column = c.isNotNull() if op == "present" else c == typed if op == "=" else c > typed if op == ">" else c < typed
        df = df.where(test)
    return df


def search(template: str, types: Mapping[str, DataFrame], keys: Mapping[str, str], links: Mapping[tuple[str, str], str]) -> DataFrame:
    """One row per match with the key of each atom in template order.  links: (outer, inner) -> the inner type's
    column that holds the outer's key, so containment is an equality join."""

    def rows(atom: Atom) -> DataFrame:
        df = _filter(types[atom.otype], atom.predicates)
        key = keys[atom.otype]
        out = df.select(*{key: F.col(key), **{c: F.col(c) for (o, i), c in links.items() if i == atom.otype}}.values())
        for child in atom.children:
            link = links[atom.otype, child.otype]
            out = out.join(rows(child).withColumnRenamed(link, "_up") if link != keys[child.otype] else rows(child).withColumn("_up", F.col(link)), F.col(key) == F.col("_up")).drop("_up")
        for child in atom.without:
            link = links[atom.otype, child.otype]
            out = out.join(rows(child).select(F.col(link).alias("_up")), F.col(key) == F.col("_up"), "left_anti")
        return out

    found = rows(parse(template)[0])
    order: list[str] = []

    def names(atom):
        order.append(keys[atom.otype])
        for c in atom.children:
            names(c)

    names(parse(template)[0])
    return found.select(*order)


def condense(matches: DataFrame, container: str, position: int, batch: int) -> DataFrame:
    """Matches per container, one page of them in key order."""
    return matches.groupBy(container).agg(F.count("*").alias("hits")).orderBy(container).offset(position).limit(batch)


def _value(word: str) -> str:
    return word[1:-1] if len(word) > 1 and word[0] == word[-1] and word[0] in "\"'" else word


def search_slots(template: str, types: Mapping[str, DataFrame], within: str = "doc", mode: str = "contains") -> DataFrame:
    """Matches of a template over slots: one column of node ids an atom, named by its place (n0, n1, ...).

    Each type has node, ``within`` (what no node crosses), lo and hi, and its features; rows whose ``extent`` is false are
    anchors and contain nothing.  Indentation means that the inner slots lie inside the outer ones.  A negated atom
    rules a container out by ``mode``: contains (it holds such a node whole), overlaps (they share a slot) or flagged
    (it has a slot inside such a node of positive width).  Joins are by buckets of the axis, so a document may be long."""
    roots = parse(template)
    names: list[str] = []

    def rows(atom: Atom) -> DataFrame:
        at = len(names)
        names.append(f"n{at}")
        df = _filter(types[atom.otype], [(n, o, _value(v)) for n, o, v in atom.predicates])
        solid = df.where("extent") if "extent" in df.columns else df
        out = (solid if atom.children or atom.without else df).select(F.col("node").alias(f"n{at}"), F.col(within).alias(f"w{at}"), F.col("lo").alias(f"lo{at}"), F.col("hi").alias(f"hi{at}"))
        for child in atom.children:
            k = len(names)
            inner = rows(child).withColumnRenamed(f"w{k}", f"w{at}")
            out = buckets.within(out, inner, f"w{at}", (f"lo{at}", f"hi{at}"), (f"lo{k}", f"hi{k}"))
        for child in atom.without:
            held = _filter(types[child.otype], [(n, o, _value(v)) for n, o, v in child.predicates])
            held = held.select(F.col(within).alias(f"w{at}"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
            if mode == "flagged":
                held = held.where("_hi > _lo")
            out = buckets.lacking(out, held, f"w{at}", (f"lo{at}", f"hi{at}"), ("_lo", "_hi"), mode != "contains")
        return out

    found = rows(roots[0])
    for root in roots[1:]:  # atoms side by side share what no node crosses
        k = len(names)
        found = found.join(rows(root), F.col("w0") == F.col(f"w{k}"))
    return found.select(*names)
