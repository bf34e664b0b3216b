"""The whole run: learn, predict, fall back, validate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from merkmal.operators.complete import apply_fallbacks, validate
from merkmal.operators.lookups import feature_mode, labelled_products, title_lookup
from merkmal.operators.scale import sent_if_small
from merkmal.operators.taxonomy import build_slots, with_slots
from merkmal.operators.textmodel import apply_choice, ensemble_choice, fit, fit_full, score
from merkmal.operators.vectors import semantic_layer
from merkmal.operators.waterfall import needs_classifier, predict_by_rules
from merkmal.session import cut_lineage


@dataclass
class Knowledge:
    """What a run needs besides the rows."""

    slots: DataFrame
    lookup: DataFrame
    mode: DataFrame
    model: DataFrame | None = None


def learn(taxonomy: DataFrame, products: DataFrame, labels: DataFrame, models: bool = False, solver: str = "rows",
          **fit_options) -> Knowledge:
    """Slots, lookups and, when asked for, both text models from the training split.

    ``solver="rows"`` runs stochastic descent on all rows of a feature, at most ``max_fit_rows`` in a task; ``"full"``
    runs a full-batch descent on all rows as Spark aggregates (``fit_full``).
    """
    slots = sent_if_small(cut_lineage(build_slots(taxonomy)))
    lookup = title_lookup(labels, products)
    model = None
    if models:
        labelled = labelled_products(labels, products, ["category", "title", "description"])
        method = {"rows": fit, "full": fit_full}[solver]
        model = cut_lineage(method(labelled, "word", **fit_options).unionByName(method(labelled, "char", **fit_options)))
    return Knowledge(slots, lookup, feature_mode(labels), model)


def classifier_layer(rows: DataFrame, slots: DataFrame, model: DataFrame, **options) -> DataFrame:
    """Score rows that need it and take the ensemble's choice where the rule allows.

    Distinct (uid, feature_name) are scored once and joined back by key, so
    duplicate work rows stay.
    """
    keys = ["uid", "feature_name", "category"]
    residue = with_slots(
        rows.filter(needs_classifier()).select(*keys, "title", "description").dropDuplicates(keys), slots, ["allowed"]
    )
    choice = ensemble_choice(score(residue, model, **options)).select(*keys, "agree", "choice", "choice_confidence")
    joined = rows.join(choice.hint("merge"), keys, "left")
    wanted = needs_classifier()
    masked = joined.withColumn("choice", F.when(wanted, F.col("choice")))
    return apply_choice(masked).select(*rows.columns)


def predict(rows: DataFrame, knowledge: Knowledge, semantic: bool = False, fuzzy: bool = True, **options) -> DataFrame:
    """Predictions for work rows, all layers in order, ``corrected`` from validation.

    The rule result is read twice by a model or vector layer (residue and all
    rows), so it is cut once in the shared folder instead of computed twice.
    """
    done = predict_by_rules(rows, knowledge.slots, knowledge.lookup, fuzzy)
    if knowledge.model is not None:
        done = classifier_layer(cut_lineage(done), knowledge.slots, knowledge.model, **options)
    if semantic:
        done = semantic_layer(cut_lineage(done), knowledge.slots)
    return validate(apply_fallbacks(done, knowledge.slots, knowledge.mode), knowledge.slots, fuzzy)
