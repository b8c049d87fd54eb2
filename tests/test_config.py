import pytest

from voicelane import config


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Session:
    def __init__(self, master, **conf):
        self.conf = _Conf({k.replace("_", "."): v for k, v in conf.items()})
        self.sparkContext = type("C", (), {"master": master})()


def test_scratch_goes_to_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = config.scratch_path(spark, "x"), config.scratch_path(spark, "x")
    assert a.startswith(f"{base}/voicelane/x-") and a != b


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        config.scratch_path(_Session("spark://host:7077"), "x")
    assert "voicelane-" in config.scratch_path(_Session("local[2]"), "x")


def test_fixed_tables_hold_their_published_values():
    """Written out here, so that a changed constant does not pass its own oracle."""
    from voicelane.operators.threshold import Assumptions
    from voicelane.plans.studies import CONFIGS

    got = [(c.max_features, c.ngram, c.C, c.use_char) for c in CONFIGS]
    assert got == [
        (3_000, (1, 1), 1.0, False), (50_000, (1, 1), 1.0, False), (50_000, (1, 2), 1.0, False),
        (50_000, (1, 2), 0.1, False), (50_000, (1, 2), 10.0, False), (50_000, (1, 2), 1.0, True),
    ]
    a = Assumptions()
    assert (a.reviews_per_month, a.p_at_risk, a.win_back_rate) == (300_000, 0.30, 0.15)
    assert (a.arpu, a.retained_months, a.contact_cost) == (10.0, 6, 1.0)
