"""Quality-class probabilities: unpacking, weighting, arg-max and the citation mix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from refgauge import fixed

_RESPONSE = (
    "map<string, struct<scores: map<string, struct<wp10: struct<score: struct<"
    "probability: map<string, double>>>>>>>"
)


def answers(response: Column, wiki: str) -> Column:
    """Map from revision id, as text, to its part of a score response."""
    return F.from_json(response, _RESPONSE)[wiki]["scores"]


def probabilities(answer: Column) -> Column:
    """Class probabilities in the part of a revision; NULL if it has none."""
    return answer["wp10"]["score"]["probability"]


def score_map(response: Column, wiki: str, revision_id: Column) -> Column:
    """Class probabilities of a revision in a score response; NULL if it has none."""
    return probabilities(answers(response, wiki)[revision_id.cast("string")])


def class_columns(scores: Column) -> list[Column]:
    """The six class columns of a probability map."""
    return [scores.getItem(name).alias(name) for name in fixed.CLASSES]


def weighted_score(scores: dict[str, Column] | None = None) -> Column:
    """Sum of class weight times probability, by class order."""
    scores = scores or {name: F.col(name) for name in fixed.CLASSES}
    terms = [scores[name] * F.lit(fixed.CLASS_WEIGHTS[name]) for name in fixed.CLASSES]
    return reduce(lambda a, b: a + b, terms)


def weighted_score_of_map(scores: Column) -> Column:
    """The same of a probability map, which may hold some of the classes only."""
    weights = F.create_map(*[F.lit(x) for pair in fixed.CLASS_WEIGHTS.items() for x in pair])
    return F.aggregate(
        F.map_entries(scores),
        F.lit(0.0),
        lambda total, entry: total + entry["value"] * weights[entry["key"]],
    )


def predicted_class(scores: dict[str, Column] | None = None) -> Column:
    """Class with the highest probability, the first in class order on ties."""
    scores = scores or {name: F.col(name) for name in fixed.CLASSES}
    top = F.greatest(*[scores[name] for name in fixed.CLASSES])
    return F.coalesce(*[F.when(scores[name] == top, F.lit(name)) for name in fixed.CLASSES])


def citation_shares(counts: dict[str, Column] | None = None) -> Column:
    """Array of (rank, source, n, percent), most cited source first, ties in source order.

    `percent` is NULL when the page cites nothing.
    """
    counts = counts or {s: F.col(f"{s}_citations") for s in fixed.CITATION_SOURCES}
    total = reduce(lambda a, b: a + b, [counts[s] for s in fixed.CITATION_SOURCES])
    ranked = F.array_sort(F.array(*[
        F.struct((-counts[s]).alias("minus"), F.lit(i).alias("place"), F.lit(s).alias("source"))
        for i, s in enumerate(fixed.CITATION_SOURCES)
    ]))
    return F.transform(ranked, lambda x, i: F.struct(
        (i + 1).alias("rank"),
        x["source"].alias("source"),
        (-x["minus"]).alias("n"),
        (-x["minus"] * F.lit(100) / F.nullif(total, F.lit(0))).alias("percent"),
    ))


def lookup(key: Column, table: dict) -> Column:
    """Value of `key` in a small fixed table, NULL if absent."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]
