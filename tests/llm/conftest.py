import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    import corpus as K

    d = tmp_path_factory.mktemp("edge")
    K.documents(spark, d, K.edge_rows())
    K.table(spark, d, "labels", [(1, 1, 0), (2, None, None), (None, 1, 1), (3, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int", ("text", "y", "role", "h", "k", "label"))
    pages = [(1, "http://A.example.NET/en/x?y#z"), (2, None), (3, "no scheme"), (4, "http://net"), (5, "https://net/"), (6, "http://m.org/fr/"), (7, "http://example.com/de/1"), (7, "http://xexample.com/de/1"), (None, "http://org/fr/#a"), (8, "http:///p"), (9, "ftp://u@net:80/")]
    K.table(spark, d, "pages", pages, "page_id long, url string", ("id", "host", "path", "key", "kind", "spread", "range", "held", "value", "row", "rule", "verdict"))
    return str(d)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    import corpus as K

    d = tmp_path_factory.mktemp("empty")
    K.documents(spark, d, [])
    K.table(spark, d, "labels", [], "doc_id long, quality int, toxic int")
    K.table(spark, d, "pages", [], "page_id long, url string")
    return str(d)
