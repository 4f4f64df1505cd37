"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

The sample table is stored once and its time reported as ``sample_table_stored``. Each model is then
fitted to its training part and scores its validation part, reported as ``<model>_score``; the rate
of scoring is taken over the whole table.
"""

from __future__ import annotations

import json
import os
import sys
import time

from clickloom.operators.split import hash_split
from clickloom.plans.models import CtrModel
from clickloom.plans.portable_net import score_portable_net
from clickloom.plans.scoring import score, throughput
from clickloom.session import materialise
from verification.compare import local_session
from verification.fixtures import DIM, LABEL, NET
from verification.queries import QUERIES, net_inputs, samples

HEADLINES = [
    "sample_table", "embedding_cosine", "ctr_quantile_bucket", "features_base", "features_inner", "features_outer",
    "fm_gd", "fm_lbfgs", "auc_roc", "portable_net_score", "batch_score", "stream_score",
]
# Query name of each model.
MODELS = {
    "nb": "nb_score", "lr": "lr_score", "fm": "fm_score", "rf": "rf_score", "gbdt": "gbt_score", "gbtlr": "gbtlr_score",
    "nn": "nn_score", "ipnn": "ipnn_score", "opnn": "opnn_score",
}


def drained(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before the clock
    seconds: dict[str, float] = {}
    rates: dict[str, int] = {}

    def timed(name: str, work):
        started = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - started, 2)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
        return result

    wanted = names or [*HEADLINES, *MODELS.values()]
    for name in (n for n in wanted if n not in MODELS.values()):
        timed(name, lambda: drained(QUERIES[name](spark, sf_dir)))
    models = {model: name for model, name in MODELS.items() if name in wanted}
    if models:
        table = timed("sample_table_stored", lambda: materialise(samples(spark, sf_dir), "samples"))
        train, validation = hash_split(table, "event_id")
    for model, name in models.items():

        def fit_and_score():
            fitted = CtrModel(model, DIM, LABEL).fit(train)
            drained(score(fitted, validation))
            return fitted

        rates[model] = round(throughput(timed(name, fit_and_score), table)["rows_per_second"])
    if not names:
        rows, started = table.count(), time.perf_counter()
        drained(score_portable_net(NET, net_inputs(table)))
        rates["portable_net"] = round(rows / (time.perf_counter() - started))
    print(json.dumps({
        "metric": "ctr_queries_total", "value": round(sum(seconds.values()), 2), "unit": "sec",
        "queries": seconds, "scored_rows_per_second": rates, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
