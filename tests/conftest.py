"""Shared fixtures: one local Spark session for the whole run and the test brand rules."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sourcelens.plans.testbed import rules as testbed_rules  # noqa: E402
from sourcelens.rules import BrandRules  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    from sourcelens.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("checkpoints")))
    yield s


@pytest.fixture(scope="session")
def rules() -> BrandRules:
    """The test brand, with app ids for the app-store rules."""
    return testbed_rules().with_(owned_app_ids=("id4410", "test.pocket.app"))


@pytest.fixture(scope="session")
def prod_rules() -> BrandRules:
    """Test brand with the default non-production prefixes (preprod, staging, dev, ...)."""
    from sourcelens.rules import DEFAULT_NONPROD_PREFIXES
    return testbed_rules().with_(nonprod_prefixes=DEFAULT_NONPROD_PREFIXES)
