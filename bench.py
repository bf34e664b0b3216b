"""Headline timings: one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the cores. The large catalog has
one product per order line key; every product asks for the five labelled
features. Each query runs into the ``noop`` sink twice and the second run counts.
Arguments choose queries; without any, all run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from merkmal.operators import lookups as L, profile as P, scoring as S, textmodel as T
from merkmal.operators.complete import apply_fallbacks, validate
from merkmal.operators.taxonomy import build_slots, distinct_values, with_slots
from merkmal.operators.text_layers import dictionary_hits
from merkmal.operators.waterfall import predict_by_rules
from merkmal.session import build_session, cut_lineage
from merkmal.sources import derived as D


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
    })
    spark.sparkContext.setLogLevel("ERROR")

    slots = cut_lineage(build_slots(D.taxonomy(spark, sf)))
    # The test tables are single files of one row group: spread what carries texts over the cores here.
    spread = lambda df: df.repartition(int(cpus), "uid")
    truth = spread(D.labels(spark, sf))
    labels = truth.filter("split = 'train'")
    parts = spread(D.products(spark, sf))
    documents = spread(D.document_catalog(spark, sf))
    lookup = cut_lineage(L.title_lookup(labels, parts))
    mode = cut_lineage(L.feature_mode(labels))
    catalog = D.order_catalog(spark, sf)
    wanted = [n for n, _, _ in D.LABELS]
    requests = D.request_rows(catalog, slots.filter(F.col("feature_name").isin(wanted)))
    every = D.request_rows(parts, slots)
    labelled = L.labelled_products(labels, parts, ["category", "title", "description"])

    def finished(rows, look):
        return validate(apply_fallbacks(predict_by_rules(rows, slots, look), slots, mode), slots)

    fitted = {}

    def fit_model():
        fitted["word"] = cut_lineage(T.fit_full(labelled, "word", epochs=10))  # epochs run as jobs inside the call
        return fitted["word"]

    asked = with_slots(truth.select("uid", "feature_name").join(parts, "uid"), slots, ["allowed"])

    queries = {
        "title_lookup": lambda: L.title_lookup(labels, parts),
        "rules_all_features": lambda: predict_by_rules(every, slots),
        "rules_large_catalog": lambda: predict_by_rules(requests, slots, lookup),
        "full_rule_run_large_catalog": lambda: finished(requests, lookup),
        "evaluation": lambda: S.evaluate(finished(truth.select("uid", "feature_name", "feature_type").join(parts, "uid"), lookup), truth),
        "word_vocabulary": lambda: T.vocabulary(labelled.withColumn("text", F.concat_ws(" ", "title", "description")), "word"),
        "dictionary_hits_documents": lambda: dictionary_hits(documents, distinct_values(slots)),
        "text_length_summary": lambda: P.text_length_summary(documents),
        "model_fit_full": fit_model,
        "model_scores": lambda: T.score(asked, fitted.get("word") or fit_model(), {"word": "plain"}),
    }
    chosen = sys.argv[1:] or list(queries)
    seconds = {}
    for name, query in queries.items():
        if name not in chosen:
            continue
        for _ in range(2):
            start = time.time()
            query().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    rows = requests.count()
    full = seconds.get("full_rule_run_large_catalog")
    per_second = round(rows / full) if full else None
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf,
        "cpus": int(cpus), "large_catalog_rows": rows, "large_catalog_rows_per_second": per_second,
    }))


if __name__ == "__main__":
    main()
