import random

from lakemart.llm.components import components


def brute(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def test_components(spark):
    draw = random.Random(3)
    path = [(i, i + 1) for i in range(100, 160)]
    draw.shuffle(path)
    cases = [
        [], [(1, 1)], [(None, 2), (3, None)], [(2, 1), (1, 2), (2, 1)], path, [(i, 7) for i in range(300)],
        [(draw.randrange(400), draw.randrange(400)) for _ in range(260)],
    ]
    for links in cases:
        found = components(spark.createDataFrame(links, "a long, b long")).collect()
        assert {row["node"]: row["root"] for row in found} == brute(links) and len(found) == len(brute(links))
