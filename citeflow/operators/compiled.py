"""Fitted trees and forests as Catalyst expressions.

A fitted classifier is read once from the driver's model (a few hundred nodes) and becomes columns:

1. *Tests.* Every split has a bit. The bits of a nominal feature come from one literal array,
   looked up by the category's index (an index outside the array goes where the split sends
   values it does not know); those of a continuous feature from comparisons. A feature with more
   than ``WORD`` splits has several such words.
2. *Leaves.* Each tree is a nested conditional over the bits that gives the number of the leaf.
3. *Votes.* Leaf numbers index literal arrays of class shares; a class's votes are added tree by
   tree, in the order of the model, so they equal the model's own doubles bit for bit.

A tree's leaves and votes run in whole-stage codegen. A forest would be one method that the JVM does not
compile any more (20 trees of depth 5: over 64 KB); its projections hold lambda functions, which
makes Spark compile them as projections of many small methods instead, whatever its settings.

No vector is assembled and no model object or UDF runs in the executors: scores are plain columns,
in a batch, a stream or inside another operator's plan. A row with a null feature gets null scores
(the model raises). What is compiled grows with the model, not with the data.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from weakref import WeakKeyDictionary

from pyspark.ml import Model, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow import constants as K

#: splits of one feature whose bits share a long (the sign bit stays free)
WORD = 62
#: splits up to which a model's leaves and votes fit one method that the JVM still compiles (8,000 bytes of bytecode)
SMALL = 64


@dataclass
class Split:
    """Where a row goes: left if the feature is at most ``threshold``, or is in ``values``
    (``inside``: those are the ones on the left; otherwise on the right)."""
    feature: int
    threshold: float | None = None
    values: tuple[float, ...] = ()
    inside: bool = True
    word: int = -1
    bit: int = 0


@dataclass
class Leaf:
    number: int
    counts: tuple[float, ...]


@dataclass
class Branch:
    split: Split
    left: Branch | Leaf
    right: Branch | Leaf


@dataclass
class Tree:
    root: Branch | Leaf
    leaves: list[Leaf] = field(default_factory=list)


def _numbers(jvm, array) -> tuple[float, ...]:
    """A Java array of doubles in one call."""
    text = jvm.java.util.Arrays.toString(array)[1:-1]
    return tuple(map(float, text.split(", "))) if text else ()


def _read(jvm, node, leaves: list[Leaf]) -> Branch | Leaf:
    if node.getClass().getSimpleName() == "LeafNode":
        leaves.append(Leaf(len(leaves), _numbers(jvm, node.impurityStats().stats())))
        return leaves[-1]
    s = node.split()
    if s.getClass().getSimpleName() == "ContinuousSplit":
        split = Split(s.featureIndex(), threshold=s.threshold())
    else:
        left = _numbers(jvm, s.leftCategories())
        # a category that the split has not seen is on the side of the larger set
        inside = len(left) <= s.numCategories() // 2
        split = Split(s.featureIndex(), values=left if inside else _numbers(jvm, s.rightCategories()), inside=inside)
    return Branch(split, _read(jvm, node.leftChild(), leaves), _read(jvm, node.rightChild(), leaves))


def _branches(node: Branch | Leaf):
    if isinstance(node, Branch):
        yield node
        yield from _branches(node.left)
        yield from _branches(node.right)


class CompiledModel:
    """A fitted decision tree or forest over the columns ``features`` (the slots of its vector)."""

    def __init__(self, model: Model, features: Sequence[str] = K.FEATURES):
        classifier = model.stages[-1] if isinstance(model, PipelineModel) else model
        java = classifier._java_obj
        self.features = list(features)
        self.is_forest = hasattr(classifier, "trees")
        jvm = SparkSession.active()._jvm
        roots = [t.rootNode() for t in java.trees()] if self.is_forest else [java.rootNode()]
        self.classes = classifier.numClasses
        if classifier.numFeatures != len(self.features):
            raise ValueError(f"the model has {classifier.numFeatures} features, {len(self.features)} are named")
        self.trees: list[Tree] = []
        for root in roots:
            leaves: list[Leaf] = []
            self.trees.append(Tree(_read(jvm, root, leaves), leaves))
        #: words of bits: feature, and the splits whose bits it holds
        self.words: list[tuple[int, list[Split]]] = []
        by_feature: dict[int, list[Split]] = {}
        for tree in self.trees:
            for b in _branches(tree.root):
                by_feature.setdefault(b.split.feature, []).append(b.split)
        for feature, splits in sorted(by_feature.items()):
            for a in range(0, len(splits), WORD):
                some = splits[a:a + WORD]
                for i, s in enumerate(some):
                    s.word, s.bit = len(self.words), 1 << i
                self.words.append((feature, some))

    def shares(self, leaf: Leaf) -> list[float]:
        """The leaf's class counts over their sum, added in order as the model does."""
        total = reduce(operator.add, leaf.counts, 0.0)
        return [c / total if total else 0.0 for c in leaf.counts]

    def word_sql(self, k: int) -> str:
        """The bits of one word, as SQL: set where a split sends the row to the left (0 for a null)."""
        feature, splits = self.words[k]
        name = f"`{self.features[feature]}`"
        nominal = [s for s in splits if s.threshold is None]
        parts = [f"IF({name} <= {s.threshold!r}D, {s.bit}L, 0L)" for s in splits if s.threshold is not None]
        if nominal:
            size = 1 + int(max((v for s in nominal for v in s.values), default=-1))
            other = sum(0 if s.inside else s.bit for s in nominal)
            table = [other] * size
            for s in nominal:
                for v in s.values:
                    table[int(v)] ^= s.bit
            # a list as text, folded into one constant array
            array = f"CAST(split('{','.join(map(str, table))}', ',') AS ARRAY<BIGINT>)" if table else "CAST(array() AS ARRAY<BIGINT>)"
            whole = f"{name} = floor({name}) AND {name} >= 0D AND {name} < {size}D"
            parts.append(f"IF({whole}, get({array}, CAST({name} AS INT)), {other}L)")
        return f"coalesce({' + '.join(parts)}, 0L)"

    def _leaf_sql(self, node: Branch | Leaf, words: Sequence[str]) -> str:
        if isinstance(node, Leaf):
            return str(node.number)
        s = node.split
        return (f"IF(({words[s.word]} & {s.bit}L) <> 0L, {self._leaf_sql(node.left, words)}, {self._leaf_sql(node.right, words)})")

    @cached_property
    def _columns(self) -> tuple[dict[str, Column], dict[str, Column], dict[str, Column], list[str]]:
        """Words and whether all features are there; leaves; votes; scores: parsed once."""
        small = sum(len(splits) for _, splits in self.words) <= SMALL
        names = [f"_word{k}" for k in range(len(self.words))]
        known = " AND ".join(f"`{f}` IS NOT NULL" for f in self.features)
        words = {n: F.expr(self.word_sql(k)) for k, n in enumerate(names)} | {"_known": F.expr(known)}
        leaves = {f"_leaf{t}": F.expr(self._leaf_sql(tree.root, names)) for t, tree in enumerate(self.trees)}
        votes = {}
        for c in range(self.classes):
            per_tree = []
            for t, tree in enumerate(self.trees):
                values = [self.shares(x)[c] if self.is_forest else x.counts[c] for x in tree.leaves]
                # leaf numbers never pass the array's end, and nothing in it is null
                per_tree.append(f"element_at(array({', '.join(f'{v!r}D' for v in values)}), _leaf{t} + 1)")
            votes[f"_votes{c}"] = F.expr("0D + " + " + ".join(per_tree))
        if not small:  # a lambda over one value: Spark then leaves these projections out of the one method
            apart = {"_known": F.expr("forall(array(_known), x -> x)")}
            leaves, votes = leaves | apart, votes | apart
        return words, leaves, votes, names

    def with_words(self, df: DataFrame) -> DataFrame:
        """``_word0`` ...: the bits of the splits; ``_known``: no feature is null."""
        return df.withColumns(self._columns[0])

    def with_leaves(self, df: DataFrame) -> DataFrame:
        """``_leaf0`` ...: the number of the row's leaf in each tree; ``_known``: no feature is null."""
        return self.with_words(df).withColumns(self._columns[1]).drop(*self._columns[3])

    def transform(self, df: DataFrame, raw: str = "raw_votes", probability: str = "probabilities", prediction: str = "prediction") -> DataFrame:
        """``df`` with ``raw_votes`` and ``probabilities`` (arrays of double by class) and ``prediction``."""
        _, leaves, votes, _ = self._columns
        out = self.with_leaves(df).withColumns(votes).drop(*[n for n in leaves if n != "_known"])
        names = [n for n in votes if n != "_known"]
        out = out.withColumn("_total", F.expr("0D + " + " + ".join(names)))
        shares = ", ".join(f"IF(_total <> 0D, {n} / _total, {n})" for n in names)
        whole = f"array({', '.join(names)})"
        return out.withColumns({
            raw: F.expr(f"IF(_known, {whole}, NULL)"), probability: F.expr(f"IF(_known, array({shares}), NULL)"),
            # the first of the largest votes
            prediction: F.expr(f"IF(_known, CAST(array_position({whole}, greatest({', '.join(names)}, 0D)) - 1 AS DOUBLE), NULL)"),
        }).drop("_known", "_total", *names)


_COMPILED: WeakKeyDictionary[Model, dict[tuple, CompiledModel]] = WeakKeyDictionary()


def compiled(model: Model, features: Sequence[str] = K.FEATURES) -> CompiledModel:
    """The compiled form of a fitted model, read once per model. A copy that was saved and loaded has the
    uid of its model; it is read itself all the same."""
    classifier = model.stages[-1] if isinstance(model, PipelineModel) else model
    forms = _COMPILED.setdefault(classifier, {})
    key = tuple(features)
    if key not in forms:
        forms[key] = CompiledModel(model, features)
    return forms[key]
