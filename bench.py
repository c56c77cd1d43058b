"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from quarrydesk.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)

    from quarrydesk.catalog import derived, queries
    from quarrydesk.operators import neardup, splits, tfidf
    from quarrydesk.plans import cleaning, training
    from quarrydesk.sources import tables

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    raw = tables.raw_tickets(spark, sf_dir)
    run(raw)
    clean = tables.clean_tickets(spark, sf_dir)
    split = derived.customer_split(spark, sf_dir)
    train = splits.train_rows(split)
    index = derived.index(spark, sf_dir)

    def near() -> None:
        run(neardup.customer_relation_summary(neardup.find_near_duplicates(clean, neardup.AUDIT_THRESHOLD)))

    def tfidf_fit() -> None:
        _, weighted = tfidf.tfidf(train)
        run(tfidf.unit_vectors(weighted))

    jobs = {
        "audit": lambda: run(queries.QUERIES["audit_report"](spark, sf_dir)),
        "clean": lambda: run(cleaning.clean_table(raw)),
        "reports_lengths": lambda: run(queries.QUERIES["length_statistics"](spark, sf_dir)),
        "splits": lambda: run(splits.customer_split(clean)),
        "tfidf_fit_transform": tfidf_fit,
        "near_duplicates": near,
        "retrieval_all_queries": lambda: run(queries.QUERIES["similar_tickets"](spark, sf_dir)),
        "calibration": lambda: run(queries.QUERIES["calibration_report"](spark, sf_dir)),
        "category_lr": lambda: training.train_category_model(split, "lr").metrics.collect(),
        "category_svm": lambda: run(queries.QUERIES["category_calibrated_svm"](spark, sf_dir)),
        "priority_forest": lambda: run(queries.QUERIES["priority_forest"](spark, sf_dir)),
        "batch_triage": lambda: run(queries.QUERIES["batch_triage"](spark, sf_dir)),
    }
    assert index.count() >= 0
    times = {}
    for name, job in jobs.items():
        began = time.time()
        job()
        times[name] = round(time.time() - began, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline jobs, total seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
