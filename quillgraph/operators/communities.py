"""Communities by greedy modularity (agglomerative) within connected components.

What a merge adds to modularity depends on the two communities and the total number of edges alone, and a merge across
components never adds to it. So components are found first by Spark, and each is agglomerated by itself.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.rows import cut, numbered

from .graph_query import both_ways


def components(edges: DataFrame, nodes: DataFrame, name: str = "name") -> DataFrame:
    """name, component: the smallest name that is reachable. Labels spread to neighbours and then to the label's label."""
    links = cut(both_ways(edges))
    labels = cut(nodes.select(F.col(name).alias("name")).union(links.select("a")).distinct().withColumn("component", F.col("name")))
    while True:
        near = links.join(labels, links["b"] == labels["name"]).groupBy("a").agg(F.min("component").alias("m"))
        spread = labels.join(near, labels["name"] == near["a"], "left").select("name", F.least("component", F.coalesce("m", "component")).alias("component"))
        jump = spread.join(spread.select(F.col("name").alias("component"), F.col("component").alias("up")), "component").select("name", F.least("component", "up").alias("component"))
        jump = cut(jump)
        if jump.join(labels.withColumnRenamed("component", "was"), "name").where("component <> was").isEmpty():
            return jump
        labels = jump


class _Greedy:
    """Communities of one component, by number. A pair's gain changes with either degree, so each pair is kept on one side alone, that with
    more neighbours, in classes of equal weight and equal degree of the other side: all pairs of a class gain alike, so a hub's best is
    found from the first name of each of its classes, and a merge into the hub touches neither its other pairs nor their sides."""

    def __init__(self, pairs: list[tuple[str, str]], total: int, resolution: float):
        self.total, self.resolution = total, resolution
        self.names = sorted({n for p in pairs for n in p})
        number = {n: i for i, n in enumerate(self.names)}
        # Numbers follow the order of names; label is the smallest number of a community, by which ties go
        self.label = list(range(len(self.names)))
        self.near: list[dict[int, float]] = [{} for _ in self.names]
        for a, b in pairs:
            i, j = number[a], number[b]
            self.near[i][j] = self.near[j][i] = 1.0
        self.degree = [float(len(x)) for x in self.near]
        #: pairs that a community keeps, with their class, and the communities that keep one with it
        self.kept: list[dict[int, tuple[float, float]]] = [{} for _ in self.names]
        self.keepers: list[set[int]] = [set() for _ in self.names]
        self.classes: list[dict[tuple[float, float], list[tuple[int, int]]]] = [{} for _ in self.names]
        self.best: list[tuple | None] = [None] * len(self.names)
        self.heap: list[tuple] = []
        self.parent = list(range(len(self.names)))

    def gain(self, i: int, weight: float, degree: float) -> float:
        return weight / self.total - self.resolution * (self.degree[i] * degree) / (2.0 * self.total * self.total)

    def keep(self, i: int, j: int) -> None:
        """The pair goes to i, in the class it now has."""
        group = self.near[i][j], self.degree[j]
        self.kept[i][j] = group
        self.keepers[j].add(i)
        heapq.heappush(self.classes[i].setdefault(group, []), (self.label[j], j))

    def drop(self, i: int, j: int) -> None:
        if j in self.kept[i]:
            del self.kept[i][j]
            self.keepers[j].discard(i)

    def first(self, i: int, group: tuple[float, float]) -> tuple | None:
        """The best pair of a class of i, as (-gain, smaller label, larger label, other side)."""
        rows, kept = self.classes[i][group], self.kept[i]
        while rows and (kept.get(rows[0][1]) != group or self.label[rows[0][1]] != rows[0][0]):
            heapq.heappop(rows)
        if not rows:
            del self.classes[i][group]
            return None
        x, y = self.label[i], rows[0][0]
        return (-self.gain(i, *group), x, y, rows[0][1]) if x < y else (-self.gain(i, *group), y, x, rows[0][1])

    def offer(self, i: int, best: tuple | None) -> None:
        self.best[i] = best
        if best:
            heapq.heappush(self.heap, (*best[:3], i))

    def choose(self, i: int) -> None:
        self.offer(i, min((f for g in list(self.classes[i]) if (f := self.first(i, g))), default=None))

    def merge(self, p: int, q: int) -> None:
        """q becomes part of p, the one with more neighbours; the smaller label stays."""
        near = self.near
        del near[p][q], near[q][p]
        self.drop(p, q)
        self.drop(q, p)
        again = {p}
        for c, w in near[q].items():
            del near[c][q]
            if q in self.kept[c]:
                self.drop(c, q)
                if self.best[c] and self.best[c][3] == q:
                    again.add(c)
            else:
                self.drop(q, c)
            if c in near[p]:
                near[p][c] = near[c][p] = near[p][c] + w
            else:
                near[p][c] = near[c][p] = w
            if p not in self.kept[c]:
                self.keep(p, c)
        near[q], self.classes[q], self.best[q] = {}, {}, None
        self.degree[p] += self.degree[q]
        self.label[p] = min(self.label[p], self.label[q])
        self.parent[q] = p
        for c in list(self.keepers[p]):
            if len(near[p]) > 2 * len(near[c]):
                self.drop(c, p)
                self.keep(p, c)
                if self.best[c] and self.best[c][3] == p:
                    again.add(c)
                continue
            self.keep(c, p)
            if self.best[c] is None or self.best[c][3] == p:
                again.add(c)
            else:
                new = self.first(c, self.kept[c][p])
                if new < self.best[c]:
                    self.offer(c, new)
        for c in again:
            self.choose(c)

    def run(self) -> dict[str, str]:
        for i, others in enumerate(self.near):
            for j in others:
                if (len(others), i) > (len(self.near[j]), j):
                    self.keep(i, j)
        for i in range(len(self.names)):
            self.choose(i)
        while self.heap:
            *found, i = heapq.heappop(self.heap)
            if self.best[i] is None or tuple(found) != self.best[i][:3]:
                continue
            if -found[0] <= 1e-15:
                break
            j = self.best[i][3]
            self.merge(*((i, j) if len(self.near[i]) >= len(self.near[j]) else (j, i)))
        out = {}
        for i, name in enumerate(self.names):
            root = i
            while self.parent[root] != root:
                root = self.parent[root]
            while self.parent[i] != root:
                self.parent[i], i = root, self.parent[i]
            out[name] = self.names[self.label[root]]
        return out


def agglomerate(pairs: list[tuple[str, str]], total: int, resolution: float = 1.0) -> dict[str, str]:
    """Greedy modularity of one component whose graph's edges number `total` in all; ties go to the smaller names."""
    return _Greedy(pairs, total, resolution).run()


def detect(edges: DataFrame, nodes: DataFrame, resolution: float = 1.0, name: str = "name") -> DataFrame:
    """community_id, name: ids from 0 by size (large first), then by smallest member. Nodes without edges stand alone. A
    component is agglomerated in one task: its edges must fit there."""
    pairs = both_ways(edges).where("a < b")
    total = pairs.count()
    comp = components(edges, nodes, name)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = agglomerate(list(zip(pdf["a"], pdf["b"], strict=True)), total, resolution)
        return pd.DataFrame({"name": list(found), "rep": list(found.values())})

    inside = pairs.join(comp.withColumnRenamed("name", "a"), "a").groupBy("component").applyInPandas(run, "name string, rep string")
    alone = comp.join(inside.select("name"), "name", "left_anti").select("name", F.col("name").alias("rep"))
    member = inside.unionByName(alone)
    sizes = member.groupBy("rep").agg(F.count("*").alias("n"), F.min("name").alias("first"))
    ids = numbered(sizes, F.desc("n"), F.col("first")).withColumn("community_id", (F.col("place") - 1).cast("int"))
    return member.join(ids.select("rep", "community_id"), "rep").select("community_id", "name")


def modularity(edges: DataFrame, communities: DataFrame) -> DataFrame:
    pairs = both_ways(edges).where("a < b")
    c = communities.select("name", "community_id")
    tagged = pairs.join(c.select(F.col("name").alias("a"), F.col("community_id").alias("ca")), "a").join(c.select(F.col("name").alias("b"), F.col("community_id").alias("cb")), "b")
    ends = tagged.select(F.explode(F.array("ca", "cb")).alias("c"), (F.col("ca") == F.col("cb")).cast("double").alias("i"))
    per = ends.groupBy("c").agg(F.count("*").alias("d"), (F.sum("i") / 2).alias("l"))
    m = F.sum("d").over(Window.partitionBy()) / 2
    return per.withColumn("m", m).agg(F.sum(F.col("l") / F.col("m") - F.pow(F.col("d") / (2 * F.col("m")), 2)).alias("modularity"))
