"""Licence scans by a trained paragraph classifier.

A paragraph is a line of a text. Its features are hashed single words and word pairs (A-Z
lower-cased), weighted by one over the root of their number. A multinomial logistic regression
(Spark ML) is trained on notices of each licence family, with words dropped, swapped and framed
by other text, against paragraphs of the corpus (at most ``UNKNOWN_ROWS`` different ones, by the least
hash) that resemble no template: the unknown class. On rows kept from the fit, a temperature
is chosen that makes the probabilities fit their outcomes.

A paragraph is taken for a family if that is its most probable class with at least ``LEAST``; the
finding is confirmed if the share of the words of the best template of that family that stand in
the paragraph is at least ``SIMILAR``.

Results: a null or empty text has no paragraphs; blank lines are not paragraphs; a paragraph of
any length is scored whole; repeated rows give equal rows; an empty input gives no rows;
other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.llm.common import U64, document_columns, least_hashed, mix, read, text_blocks, word_hashes

SLOTS = 1 << 14
UNKNOWN_ROWS = 3000
VARIANTS = 60
LEAST = 0.5
SIMILAR = 0.6

# Short notices by which licence families are commonly declared.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the 3-clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc_by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc_by_nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "reserved": [
        "All rights reserved.",
        "Copyright (c) 2020 the authors. All rights reserved.",
    ],
}
FAMILIES = ["unknown", *TEMPLATES]


def _words(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    hashes, bounds, *_ = word_hashes(lines)
    return hashes, bounds


def _slots(hashes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of words and of pairs within a group, and the group of each."""
    one = (mix(hashes) % U64(SLOTS)).astype(np.int64)
    both = group[1:] == group[:-1]
    two = (mix(hashes[:-1] * U64(0x9E3779B97F4A7C15) + hashes[1:]) % U64(SLOTS)).astype(np.int64)[both]
    return np.concatenate([one, two]), np.concatenate([group, group[:-1][both]])


def _template_words() -> list[tuple[int, np.ndarray]]:
    out = []
    for i, notices in enumerate(TEMPLATES.values(), 1):
        hashes, bounds = _words([t.encode() for t in notices])
        out += [(i, np.unique(hashes[a:b])) for a, b in zip(bounds, bounds[1:])]
    return out


def similarity(words: np.ndarray, templates: list[tuple[int, np.ndarray]], family: int = 0) -> float:
    """The largest share of a template's words that stand in ``words`` (of one family, or of any)."""
    return max((float(np.isin(t, words).mean()) for f, t in templates if family in (0, f)), default=0.0)


def _training_rows(paragraphs: list[str], seed: int = 11) -> tuple[list[bytes], np.ndarray]:
    rng = np.random.default_rng(seed)
    own = _template_words()
    hashes, bounds = _words([p.encode() for p in paragraphs])
    other = [p for p, a, b in zip(paragraphs, bounds, bounds[1:]) if similarity(hashes[a:b], own) < SIMILAR]
    frames = [p.split()[:8] for p in other] or [[]]
    lines, labels = [p.encode() for p in other], [0] * len(other)
    for label, notices in enumerate(TEMPLATES.values(), 1):
        for notice in notices:
            for v in range(VARIANTS):
                words = notice.split()
                if v and len(words) > 4:
                    words = [w for w in words if rng.random() > 0.06]
                if v % 4 == 1:
                    words = frames[rng.integers(len(frames))] + words
                if v % 4 == 2:
                    words = words + frames[rng.integers(len(frames))]
                lines.append(" ".join(words).encode())
                labels.append(label)
    return lines, np.array(labels)


def train(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights (slot by family), intercepts and the temperature. The driver holds the bounded
    training rows; the fit is Spark's."""
    spark = docs.sparkSession
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length(F.trim("line")) > 0)
    some = lines.groupBy("line").agg(F.lit(1).alias("one"))
    distinct = lines.select(F.xxhash64("line").alias("line")).distinct().count()  # by hashes: lines do not move for it
    picked = least_hashed(some, "line", UNKNOWN_ROWS, distinct).toPandas()["line"].tolist()
    lines, labels = _training_rows(picked)
    hashes, bounds = _words(lines)
    group = np.repeat(np.arange(len(lines)), np.diff(bounds))
    slots, of = _slots(hashes, group)
    order = np.argsort(of, kind="stable")
    slots, cuts = slots[order], np.searchsorted(of[order], np.arange(len(lines) + 1))
    held = np.random.default_rng(5).random(len(lines)) < 0.2
    rows = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        cell, n = np.unique(slots[a:b], return_counts=True)
        rows.append((float(labels[i]), bool(held[i]), Vectors.sparse(SLOTS, cell.tolist(), (n / np.sqrt(max(1, b - a))).tolist())))
    data = spark.createDataFrame(rows, ["label", "held", "features"]).repartition(2)
    fitted = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60, standardization=False).fit(data.where("not held"))
    weights = np.zeros((SLOTS, len(FAMILIES)), np.float32)
    matrix = fitted.coefficientMatrix.toArray()
    weights[:, :matrix.shape[0]] = matrix.T
    intercepts = np.full(len(FAMILIES), -50.0)
    intercepts[:matrix.shape[0]] = fitted.interceptVector.toArray()
    kept = np.flatnonzero(held)
    scores = np.array([weights[slots[cuts[i]:cuts[i + 1]]].sum(axis=0) / np.sqrt(max(1, cuts[i + 1] - cuts[i])) + intercepts for i in kept])

    def loss(t: float) -> float:
        z = scores / t
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(kept)), labels[kept]]).mean())

    temperature = min(np.geomspace(0.25, 8, 41).tolist(), key=loss) if len(kept) else 1.0
    return weights, intercepts, temperature


def scan(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """Per row: ``doc_id, n_paragraphs, findings`` (of ``paragraph, family, probability, similarity,
    confirmed``, by position), ``families`` (confirmed ones, sorted)."""
    table = docs.sparkSession.sparkContext.broadcast(model)
    finding = pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercepts, temperature = table.value
        templates = _template_words()
        for batch in batches:
            for rows, texts in text_blocks(batch, "text"):
                hashes, bounds, starts, _, buf = word_hashes(texts)
                breaks = np.flatnonzero(buf == 10)
                line = np.searchsorted(breaks, starts)
                first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
                n = len(first)
                group = np.repeat(np.arange(n), np.diff(np.append(first, len(line))))
                out: list[list[dict]] = [[] for _ in texts]
                owner = np.searchsorted(bounds, first, "right") - 1
                number = np.arange(n) - np.searchsorted(first, bounds[:-1])[owner] if n else first
                if n:
                    slots, of = _slots(hashes, group)
                    size = np.bincount(of, minlength=n)
                    z = np.stack([np.bincount(of, weights=weights[slots, f], minlength=n) for f in range(len(FAMILIES))], axis=1)
                    z = (z / np.sqrt(size)[:, None] + intercepts) / temperature
                    p = np.exp(z - z.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                    best = p.argmax(axis=1)
                    for i in np.flatnonzero((best > 0) & (p.max(axis=1) >= LEAST)):
                        words = hashes[first[i]:first[i + 1] if i + 1 < n else len(hashes)]
                        near = similarity(words, templates, int(best[i]))
                        out[owner[i]].append({"paragraph": int(number[i]), "family": FAMILIES[best[i]], "probability": float(p[i].max()),
                                              "similarity": near, "confirmed": near >= SIMILAR})
                paragraphs = np.bincount(owner, minlength=len(texts)) if n else np.zeros(len(texts), np.int64)
                families = [sorted({f["family"] for f in own if f["confirmed"]}) for own in out]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[rows], pa.array(paragraphs, pa.int64()), pa.array(out, pa.list_(finding)), pa.array(families, pa.list_(pa.string()))],
                                                 ["doc_id", "n_paragraphs", "findings", "families"])

    schema = ("doc_id long, n_paragraphs long, findings array<struct<paragraph:int,family:string,probability:double,similarity:double,confirmed:boolean>>, families array<string>")
    return docs.mapInArrow(work, schema)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: licence families found in their paragraphs."""
    docs = document_columns(read(spark, sf_dir, "documents"))
    return scan(docs, train(docs))
