"""Graph operators over edge tables: reachability, components, layers, labels, unused nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import materialize, scratch


class _Growing:
    """A table that grows round by round; a round writes what is new and nothing else."""

    def __init__(self, first: DataFrame, label: str):
        self.spark, self.label, self.paths = first.sparkSession, label, []
        self.schema = first.schema
        self.new = self.add(first)

    def add(self, df: DataFrame) -> DataFrame:
        """Write rows; the rows as written."""
        path = scratch(self.spark, self.label)
        df.write.parquet(path)
        self.paths.append(path)
        self.new = self.spark.read.schema(self.schema).parquet(path)
        return self.new

    def all(self) -> DataFrame:
        """All rows so far."""
        return self.spark.read.schema(self.schema).parquet(*self.paths)


def closure(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """All pairs (src, dst) with a path from src to dst, by path doubling over what is new.

    A round joins the pairs of the round before with all pairs known, on either side, and keeps those not known yet; paths
    of n edges take log2(n) rounds. Each round writes its new pairs to the shared folder: lineage stays short and a lost executor
    costs one round.
    """
    known = _Growing(edges.where("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct(), "paths")
    step = lambda a, b: a.select("src", F.col("dst").alias("mid")).join(b.select(F.col("src").alias("mid"), "dst"), "mid").select("src", "dst")
    for _ in range(rounds):
        all_ = known.all()
        longer = step(known.new, all_).unionByName(step(all_, known.new)).distinct()
        if known.add(longer.join(all_, ["src", "dst"], "left_anti")).isEmpty():
            return known.all()
    raise ValueError("the closure has not settled")


def depths(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, depth): the number of edges to the root, in a forest (edges from child src to its one parent dst).

    Pointers double: each node holds its distance to one ancestor, and takes over that ancestor's; a row a node, log2 of the
    greatest depth rounds.
    """
    e = edges.where("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct()
    nodes = e.select(F.col("src").alias("node")).union(e.select(F.col("dst").alias("node"))).distinct()
    at = nodes.join(e, F.col("node") == F.col("src"), "left").select("node", F.col("dst").alias("up"), F.when(F.col("dst").isNull(), 0).otherwise(1).cast("long").alias("depth"))
    at = materialize(at, "depths")
    for _ in range(rounds):
        if at.where("up IS NOT NULL").isEmpty():
            return at.select("node", "depth")
        over = at.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        at = materialize(at.join(over, "up", "left").select("node", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "depths")
    raise ValueError("the graph has a cycle")


def reachable(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(node): the roots and all that they reach, a frontier a round; what was seen is not expanded again."""
    e = edges.where("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct()
    seen = _Growing(roots.select("node").where("node IS NOT NULL").distinct(), "reached")
    while not seen.new.isEmpty():
        onward = e.join(seen.new.select(F.col("node").alias("src")), "src", "left_semi").select(F.col("dst").alias("node")).distinct()
        seen.add(onward.join(seen.all(), "node", "left_anti"))
    return seen.all()


def unused(nodes: DataFrame, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes that no root reaches (roots and nodes: a column node)."""
    return nodes.select("node").distinct().join(reachable(edges, roots), "node", "left_anti")


#: Rounds of trimming before colours are spread again.
TRIMS = 3


def _edges(edges: DataFrame) -> DataFrame:
    return edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").select("src", "dst").distinct()


class Rounds:
    """Counts rounds, and ends a search that has not settled."""

    def __init__(self, most: int):
        self.most, self.done = most, 0

    def __call__(self) -> None:
        self.done += 1
        if self.done > self.most:
            raise ValueError(f"the graph has not settled in {self.most} rounds")


def _trimmed(e: DataFrame, count: Rounds) -> tuple[DataFrame, int]:
    """Edges between nodes that have edges in and out: others lie on no cycle."""
    n = e.count()
    for _ in range(TRIMS):
        count()
        inner = e.select(F.col("src").alias("node")).intersect(e.select(F.col("dst").alias("node")))
        left = e.join(inner.withColumnRenamed("node", "src"), "src", "left_semi").join(inner.withColumnRenamed("node", "dst"), "dst", "left_semi")
        e = materialize(left.select("src", "dst"), "trimmed")
        before, n = n, e.count()
        if n in (0, before):
            break
    return e, n


def _coloured(e: DataFrame, count: Rounds) -> DataFrame:
    """(node, colour): of the nodes that reach a node, itself included, the greatest by a hash, so that names have no say in the rounds."""
    nodes = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()
    colour = changed = materialize(nodes.withColumn("colour", F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("of"))), "colour")
    while True:
        count()
        sent = e.join(changed.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node")).agg(F.max("colour").alias("sent"))
        changed = materialize(colour.join(sent, "node").where("sent > colour").select("node", F.col("sent").alias("colour")), "changed")
        if changed.isEmpty():
            return colour.select("node", F.col("colour.of").alias("colour"))
        newer = changed.withColumnRenamed("colour", "newer")
        colour = materialize(colour.join(newer, "node", "left").select("node", F.coalesce("newer", "colour").alias("colour")), "colour")


def components(edges: DataFrame, rounds: int = 1000) -> DataFrame:
    """(node, component) of every node of an edge: its strongly connected component, named by its least node.

    All components are sought at once. Nodes without edges in or out are trimmed; colours spread forward, so that a node's colour is one
    node that reaches it, the same for a whole component; nodes that reach the node their colour is named after, within the colour, are its component.
    What is left goes on without them and without edges between colours, which lie on no cycle. Rounds follow the length of paths
    inside the parts that hold cycles, not the number of components; each writes rows in proportion to the edges that are left.
    """
    spark, count = edges.sparkSession, Rounds(rounds)
    e = all_ = materialize(_edges(edges), "edges")
    kind = e.schema["src"].dataType.simpleString()
    path, found = scratch(spark, "components"), False
    while True:
        e, n = _trimmed(e, count)
        if not n:
            break
        colour = _coloured(e, count)
        of = lambda c: colour.select(F.col("node").alias(c), F.col("colour").alias(f"of_{c}"))
        inside = materialize(e.join(of("src"), "src").join(of("dst"), "dst").where("of_src = of_dst").select("src", "dst", F.col("of_src").alias("colour")), "inside")
        reached = _Growing(colour.where("node = colour"), "seen")
        while not reached.new.isEmpty():
            count()
            back = inside.join(reached.new.select(F.col("node").alias("dst")), "dst", "left_semi").select(F.col("src").alias("node"), "colour").distinct()
            reached.add(back.join(reached.all(), "node", "left_anti"))
        seen = reached.all()
        seen.write.mode("append").parquet(path)
        found = True
        left = inside.join(seen.select(F.col("node").alias("src")), "src", "left_anti").join(seen.select(F.col("node").alias("dst")), "dst", "left_anti")
        e = materialize(left.select("src", "dst"), "left")
    nodes = all_.select(F.col("src").alias("node")).union(all_.select("dst")).distinct()
    if not found:
        return nodes.withColumn("component", F.col("node"))
    done = spark.read.schema(f"node {kind}, colour {kind}").parquet(path)
    least = done.groupBy("colour").agg(F.min("node").alias("component"))
    done = done.join(least, "colour").select("node", "component")
    return nodes.join(done, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def condensed(nodes: DataFrame, edges: DataFrame, rounds: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(node, component) of all nodes, and the edges between components, which hold no cycle."""
    e = _edges(edges)
    of = components(e, rounds)
    of = materialize(nodes.select("node").where("node IS NOT NULL").distinct().join(of, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "components")
    named = lambda c: of.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    between = e.join(named("src"), "src").join(named("dst"), "dst").where("of_src <> of_dst").select(F.col("of_src").alias("src"), F.col("of_dst").alias("dst")).distinct()
    return of, materialize(between, "between")


def layers(nodes: DataFrame, edges: DataFrame, rounds: int = 1000) -> DataFrame:
    """(node, layer): a node's layer lies above those of all that it depends on (edges from src to what it needs, dst).

    Nodes that depend on each other share a component and so a layer. Each round takes the components without open needs and appends
    them to one table.
    """
    of, e = condensed(nodes, edges, rounds)
    return of.join(_layered(of.select(F.col("component").alias("node")).distinct(), e).withColumnRenamed("node", "component"), "component").select("node", "layer")


def _layered(nodes: DataFrame, e: DataFrame, labels: int = 0) -> DataFrame:
    """(node, layer) of a graph without cycles, with lo and hi: arrays of the least and greatest of labels hashes among all that a node reaches."""
    spark, path, layer = nodes.sparkSession, scratch(nodes.sparkSession, "layers"), 0
    own = [F.xxhash64(F.lit(k), "node").alias(f"h{k}") for k in range(labels)]
    left = materialize(nodes.select("node", *own), "nodes")
    kind, at = left.schema["node"].dataType.simpleString(), range(labels)
    schema = f"node {kind}, " + "".join(f"lo{k} long, hi{k} long, " for k in at) + "layer int"
    waiting = e
    known = None  # labels so far; a free node's needs are all among them
    while not left.isEmpty():
        free = left.join(waiting.select(F.col("src").alias("node")).distinct(), "node", "left_anti")
        ranges = [x for k in at for x in (F.least(f"h{k}", f"_lo{k}").alias(f"lo{k}"), F.greatest(f"h{k}", f"_hi{k}").alias(f"hi{k}"))]
        if labels and known is not None:
            below = e.join(known.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node"))
            below = below.agg(*[x for k in at for x in (F.min(f"lo{k}").alias(f"_lo{k}"), F.max(f"hi{k}").alias(f"_hi{k}"))])
            free = free.join(below, "node", "left").select("node", *ranges)
        elif labels:
            free = free.select("node", *[x for k in at for x in (F.col(f"h{k}").alias(f"lo{k}"), F.col(f"h{k}").alias(f"hi{k}"))])
        free = materialize(free.withColumn("layer", F.lit(layer)), "free")
        free.write.mode("append").parquet(path)
        if labels:
            known = spark.read.schema(schema).parquet(path).drop("layer")
        left = materialize(left.join(free.select("node"), "node", "left_anti"), "nodes")
        waiting = materialize(waiting.join(free.select(F.col("node").alias("dst")), "dst", "left_anti").select("src", "dst"), "waiting")
        layer += 1
    return spark.read.schema(schema).parquet(path) if layer else spark.createDataFrame([], schema)


#: Independent ranges of a node's label.
LABELS = 3


class Reachability:
    """Labels of a graph's components, for telling whether pairs of nodes are connected by a path without a closure.

    A component's label is its layer and, for each of LABELS hashes, the range of that hash over all that it reaches, found in one pass
    over the layers. A path from a to b is possible only if a's layer is the higher one and each of b's ranges lies in a's. Pairs for which
    it is are searched: all at once, a step a round, from a towards b, and only over components whose labels still allow b.
    """

    def __init__(self, nodes: DataFrame, edges: DataFrame, rounds: int = 1000):
        self.of, self.edges = condensed(nodes, edges, rounds)
        self.labels = _layered(self.of.select(F.col("component").alias("node")).distinct(), self.edges, LABELS)

    def _label(self, name: str) -> DataFrame:
        return self.labels.select(*[F.col(c).alias(f"{name}_{c}") for c in self.labels.columns])

    @staticmethod
    def _may(a: str, b: str) -> F.Column:
        inside = F.col(f"{a}_layer") > F.col(f"{b}_layer")
        for k in range(LABELS):
            inside &= (F.col(f"{a}_lo{k}") <= F.col(f"{b}_lo{k}")) & (F.col(f"{a}_hi{k}") >= F.col(f"{b}_hi{k}"))
        return inside

    def reaches(self, pairs: DataFrame) -> DataFrame:
        """pairs (a, b) of nodes, each once, with reaches: whether edges lead from a to b; a node reaches itself, a null or unknown one nothing."""
        of = lambda c: self.of.select(F.col("node").alias(c), F.col("component").alias(f"{c}_node"))
        p = pairs.select("a", "b").distinct()
        p = materialize(p.join(of("a"), "a").join(of("b"), "b"), "pairs")
        same = p.where("a_node = b_node").select("a_node", "b_node").distinct()
        goals = self._label("b")
        open_ = p.where("a_node <> b_node").select("a_node", "b_node").distinct().join(self._label("a"), "a_node").join(goals, "b_node").where(self._may("a", "b"))
        # at: where the search for a pair has come to; pairs are asked once, however many nodes share their components.
        seen = _Growing(open_.select("a_node", "b_node", F.col("a_node").alias("at")), "at")
        at = seen.new
        found = [same]
        while not at.isEmpty():
            step = at.join(self.edges.select(F.col("src").alias("at"), F.col("dst").alias("at_node")), "at").select("a_node", "b_node", "at_node").distinct()
            hit = materialize(step.where("at_node = b_node").select("a_node", "b_node").distinct(), "hits")
            found.append(hit)
            on = step.join(hit, ["a_node", "b_node"], "left_anti").join(self._label("at"), "at_node").join(goals, "b_node").where(self._may("at", "b"))
            on = on.select("a_node", "b_node", F.col("at_node").alias("at"))
            at = seen.add(on.join(seen.all(), ["a_node", "b_node", "at"], "left_anti"))
        hits = found[0]
        for f in found[1:]:
            hits = hits.unionByName(f)
        hits = hits.distinct().withColumn("reaches", F.lit(True))
        known = p.join(hits, ["a_node", "b_node"], "left").select("a", "b", "reaches")
        return pairs.select("a", "b").distinct().join(known, ["a", "b"], "left").select("a", "b", F.coalesce("reaches", F.lit(False)).alias("reaches"))
