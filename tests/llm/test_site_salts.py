import numpy as np

from emberline.llm import site_lines as H


def test_salts_change_nothing(spark, monkeypatch):
    """One host holds a third of all pages; rows are the same whether a host has one salt or hundreds."""
    r = np.random.default_rng(4)
    pages = []
    for k in range(900):
        host = "big.example" if k % 3 == 0 else f"h{k % 40}.example"
        lines = ["Home", f"story {k}", *(f"often {x}" for x in r.integers(0, 4, 2)), *(f"rare {x}" for x in r.integers(0, 300, 2))]
        pages.append((k, f"https://{host}/{k}", "".join(f"<p>{x}</p>" for x in lines)))
    pages += [(5, None, None), (5, None, None), (None, "https://big.example/", "<p>Home</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    want = sorted(map(str, H.drop_site_lines(df).collect()))
    assert len(want) == len(pages) and any("Home" not in x and "n_dropped=1" in x for x in want)
    monkeypatch.setattr(H, "PAGES_A_SALT", 2)
    assert sorted(map(str, H.drop_site_lines(df).collect())) == want
