"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = ["p09_select_features", "h17_compare_classes", "d01_ks_drift", "h06_feature_row", "h06_feature_row_all",
            "e05_roc_auc", "h16_correlation_matrix", "r16_stratified_split", "h08_box_stats", "t03_rms_energy",
            "t09_silences", "f05_spectral_centroid", "f18_spectrum_overlay", "v05_jitter", "v09_speech_rate",
            "h04_windowed_stats", "p12_prepare", "m01_logistic"]


def main() -> None:
    from voxledger.plans import catalog
    from voxledger.session import build_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session("voxledger-bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    out: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for k in range(repeat + 1):  # the first run warms up
            t = time.perf_counter()
            catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            if k:
                times.append(time.perf_counter() - t)
        out[name] = round(statistics.median(times), 3)
        print(name, out[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, median of %d after one warm-up" % repeat, "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": Path(sf).name, "cpus": cpus, "shuffle_partitions": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
