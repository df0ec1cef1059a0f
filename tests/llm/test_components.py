import random

from crowdpulse.llm.components import connected_components

from test_simhash import classes


def test_random_links(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    links += [(i, i + 1) for i in range(300, 360)] + [(900, 900), (-5, 700)]  # a path, a loop
    links += [(1000, i) for i in range(1001, 1400)]  # a hub
    nodes = {n for link in links for n in link if link[0] != link[1]}
    expected = classes(nodes, [x for x in links if x[0] != x[1]])
    df = spark.createDataFrame(links + [(None, 3)], "a long, b long").repartition(3)
    assert {r[0]: r[1] for r in connected_components(df).collect()} == expected


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
