import numpy as np
import pytest
from cultures import culture

from spikeloom.operators import detectors, intervals, models

STRONG = {"well": "strong", "units": 24, "duration": 110.0, "centers": [12.5, 31.0, 50.5, 70.0, 91.5], "width": 0.5, "burst_rate": 90.0, "base_rate": 0.03, "recruitment": 1.0, "seed": 7}
QUIET = {"well": "quiet", "units": 30, "duration": 50.0, "centers": [], "width": 0.5, "burst_rate": 0.0, "base_rate": 0.9, "recruitment": 0.0, "seed": 8}
CASCADE = {"well": "cascade", "units": 16, "duration": 85.0, "centers": [9.0, 26.5, 43.0, 58.5, 74.0], "width": 0.5, "burst_rate": 65.0, "base_rate": 1.8, "recruitment": 0.9, "seed": 9}


@pytest.fixture(scope="module")
def cultures(spark):
    spikes, truth = culture(spark, [STRONG, QUIET, CASCADE])
    return spikes.cache(), truth.cache()


def test_population_bursts_find_the_injected_ones(cultures):
    spikes, truth = cultures
    found = detectors.population_bursts(spikes)
    network = found["network_bursts"].toPandas()
    assert 4 <= (network.well == "strong").sum() <= 7
    assert network.participation.between(0, 1).all() and (network.end > network.start).all()
    scores = intervals.detection_scores(found["network_bursts"], truth, ["well"]).toPandas().set_index("well")
    assert scores.recall["strong"] == 1.0
    assert (found["burstlets"].groupBy("well").count().toPandas()["count"] > 0).all()
    least = float(network.duration.median()) + 1e-9
    fewer = detectors.population_bursts(spikes, min_network=least)["network_bursts"].toPandas()
    assert sorted(fewer.start) == sorted(network[network.duration >= least].start) and len(fewer) < len(network)


@pytest.mark.parametrize("options", [{"clustering": "threshold"}, {"axes": 5}])
def test_model_bursts_find_the_injected_ones(cultures, options):
    spikes, truth = cultures
    found = detectors.model_bursts(spikes.where("well = 'cascade'"), **options)
    network = found["network_bursts"].toPandas()
    scores = intervals.detection_scores(found["network_bursts"], truth.where("well = 'cascade'"), ["well"]).first()
    assert scores.recall == 1.0 and scores.precision >= 0.5
    assert len(network) >= 5
    rows = found["features"].toPandas()
    assert np.isfinite(rows[models.FEATURES].to_numpy()).all()
    assert rows[rows.on].post_frac_gt_0_5.mean() > rows[~rows.on].post_frac_gt_0_5.mean() + 0.3
    assert set(rows.decision) <= ({"threshold"} if options.get("clustering") else {"density", "density_single"})


def test_a_well_of_noise_falls_back_to_the_threshold(spark):
    rng = np.random.default_rng(6)
    rows = [("w", k, *map(float, rng.uniform(0, 1, len(models.FEATURES)))) for k in range(40)]
    bins = spark.createDataFrame(rows, "well string, bin long, " + ", ".join(f"{c} double" for c in models.FEATURES))
    out = detectors.cluster_bins(bins, min_cluster_size=30).collect()
    assert {r.decision for r in out} == {"all_noise"}
    assert all((r.label, r.on) == ((1, True) if r.post_frac_gt_0_5 > 0.3 else (-1, False)) and r.probability == r.post_frac_gt_0_5 for r in out)


def test_fit_recovers_rates():
    rng = np.random.default_rng(12)
    n = rng.poisson(2 * 0.02, 4000)
    for a, b in ((150, 260), (1100, 1230), (2300, 2440), (3300, 3410)):
        n[a:b] = rng.poisson(40 * 0.02, b - a)
    fit = models.fit_counts(n.astype(float), 0.02)
    assert fit["skipped"] is None and abs(fit["lambda_bg"] - 2) < 1 and abs(fit["lambda_burst"] - 40) < 20
    assert models.fit_counts(np.eye(1, 4000)[0] * 4, 0.02)["skipped"] == "low_spike_count"
    assert models.fit_counts(rng.poisson(0.14, 4000).astype(float), 0.02, min_ratio=50)["skipped"] == "low_rate_ratio"


def test_find_peaks_matches_a_plain_search():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = rng.integers(0, 6, rng.integers(3, 30)).astype(float)
        height, prominence = float(rng.integers(0, 4)), float(rng.integers(0, 4))
        want = []
        k = 1
        while k < len(x) - 1:
            e = k
            while e + 1 < len(x) and x[e + 1] == x[k]:
                e += 1
            if x[k - 1] < x[k] and e + 1 < len(x) and x[e + 1] < x[k] and x[k] >= height:
                mid, low_left, low_right = (k + e) // 2, x[k], x[k]
                i = mid
                while i >= 0 and x[i] <= x[k]:
                    low_left = min(low_left, x[i])
                    i -= 1
                i = mid
                while i < len(x) and x[i] <= x[k]:
                    low_right = min(low_right, x[i])
                    i += 1
                if x[k] - max(low_left, low_right) >= prominence:
                    want.append(mid)
            k = e + 1
        assert detectors.find_peaks(x, height, prominence) == want


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 3000])
def test_chains_in_blocks_are_those_of_one_run(n):
    rng = np.random.default_rng(n)
    counts = rng.poisson(np.where(rng.random(n) < 0.1, 5, 0.2)).astype(float)
    rates, move, start = np.array([0.3, 4.0]), np.array(models.TRANSITION), np.array(models.START)
    emission = counts[:, None] * np.log(rates) - rates
    like = np.exp(emission)
    ahead, behind, scale = np.empty((n, 2)), np.ones((n, 2)), np.empty(n)
    for t in range(n):
        a = (start if t == 0 else ahead[t - 1] @ move) * like[t]
        scale[t] = a.sum()
        ahead[t] = a / scale[t]
    for t in range(n - 2, -1, -1):
        behind[t] = move @ (like[t + 1] * behind[t + 1]) / scale[t + 1]
    moved = sum((np.outer(ahead[t], like[t + 1] * behind[t + 1] / scale[t + 1]) * move for t in range(n - 1)), np.zeros((2, 2)))
    gamma, got, ll = models._smooth_chain(emission, move, start)
    assert np.allclose(gamma, ahead * behind, atol=1e-9) and np.allclose(got, moved, atol=1e-9) and abs(ll - np.log(scale).sum()) < 1e-7
