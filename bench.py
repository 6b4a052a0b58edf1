"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from framelearn.plans import catalog  # noqa: E402
from framelearn.session import get_spark  # noqa: E402

HEADLINE = [
    "tok_1_tokenize",
    "tok_4_vocab",
    "tok_8_encode_unk",
    "tok_17_lm_windows",
    "tok_18_lm_dataset",
    "tok_18_lm_dataset_shuffled",
    "tok_12_bpe_train",
    "tok_13_bpe_encode",
    "a_17_r2",
    "a_21_macro_f1",
    "a_23_epoch_batch_mean",
    "ord_4_split_random",
    "ord_5_batches_drop_last",
    "j_6_matmul",
    "vec_5_knn_join",
    "ml_2_fit_linear",
    "ml_3_predict_mlp",
    "ml_6_fit_classes",
    "ml_14_conv2d",
    "ml_15_predict_cnn",
    "ml_16_message_layer",
    "ml_17_predict_graph",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    # one untimed run, so that starting the JVM code and the Python workers is not charged to a query
    catalog.QUERIES["ml_3_predict_mlp"](spark, sf_dir).count()
    catalog.QUERIES["tok_1_tokenize"](spark, sf_dir).count()
    times = {}
    for name in names:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
