"""Seeded synthetic cultures with known bursts: positive and negative controls for the detectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def culture(spark: SparkSession, specs: list[dict]) -> tuple[DataFrame, DataFrame]:
    """(spikes, truth) of cultures; a spec has well, units, duration, centers, width, burst_rate, base_rate, recruitment, seed.

    Each culture is generated by a task of its own. Recruited units fire at burst_rate during a burst, all at base_rate outside.
    """
    truth = [(s["well"], float(c - s["width"] / 2), float(c + s["width"] / 2)) for s in specs for c in s["centers"]]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        def poisson(rate: float, spans: list[tuple[float, float]]) -> np.ndarray:
            """Homogeneous spikes within each span."""
            return np.concatenate([np.empty(0), *(rng.uniform(a, b, rng.poisson(rate * (b - a))) for a, b in spans if b > a)])

        out = []
        for s in pdf.to_dict("records"):
            rng, spans = np.random.default_rng(int(s["seed"])), [(c - s["width"] / 2, c + s["width"] / 2) for c in s["centers"]]
            edges = [0.0, *[x for span in spans for x in span], s["duration"]]
            for u in range(int(s["units"])):
                base = poisson(s["base_rate"], list(zip(edges[::2], edges[1::2])))
                burst = poisson(s["burst_rate"], [x for x in spans if rng.random() < s["recruitment"]])
                out.append(pd.DataFrame({"well": s["well"], "unit_id": f"unit_{u:03d}", "t": np.sort(np.concatenate([base, burst]))}))
        return pd.concat(out)

    frame = pd.DataFrame([s | {"centers": list(map(float, s["centers"]))} for s in specs])
    kinds = "well string, units int, duration double, centers array<double>, width double, burst_rate double, base_rate double, recruitment double, seed long"
    rows = spark.createDataFrame(frame[[k.split()[0] for k in kinds.split(", ")]], kinds)
    spikes = rows.groupBy("well").applyInPandas(one, "well string, unit_id string, t double")
    return spikes, spark.createDataFrame(truth, "well string, start double, end double")
