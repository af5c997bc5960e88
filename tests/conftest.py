from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sent_to_all(spark):
    """Tells how many rows the largest broadcast had since the test began."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()

    def most() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        found = [0]
        runs = store.executionsList()
        for k in range(before, runs.size()):
            ran = runs.apply(k).executionId()
            told = store.executionMetrics(ran)
            nodes = store.planGraph(ran).allNodes()
            for node in (nodes.apply(i) for i in range(nodes.size())):
                if node.name() == "BroadcastExchange":
                    metrics = node.metrics()
                    for metric in (metrics.apply(i) for i in range(metrics.size())):
                        if metric.name() == "number of output rows" and told.contains(metric.accumulatorId()):
                            found.append(int(told.apply(metric.accumulatorId()).replace(",", "")))
        return max(found)

    return most
