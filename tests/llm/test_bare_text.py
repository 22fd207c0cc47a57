"""Main text that stands directly in the body."""

import pytest

from chronofeat.llm.html_extract import extract_main_text, train_extractor

A = "The river rose slowly through the night, and by the morning the lower fields stood under water; nobody had expected it. "
B = "A second part of the story follows here, with more than one sentence. It goes on for a while, as articles do, and then ends. "
HEAD = "<html><head><title>t</title></head><body>"


@pytest.fixture(scope="module")
def text_of(spark, sf_dir):
    model = train_extractor(spark.read.parquet(f"{sf_dir}/pages.parquet"), sample=60)

    def run(pages):
        df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").selectExpr("page_id", "'u' as url", "html")
        return [r.text for r in sorted(extract_main_text(df, model).collect())]
    return run


def test_text_directly_in_the_body(text_of):
    a, b = A.strip(), B.strip()
    got = text_of([
        f"{HEAD}text<br>text</body></html>", f"{HEAD}{A}<br>{B}</body></html>", f"<html><body>{A * 3}<footer>(c) us</footer></body></html>",
        f"<html><body>{A * 3}<div class='ad'>Buy now</div>{B * 3}<nav><a href='/'>Home</a> <a href='/x'>News</a></nav></body></html>",
        f"{HEAD}<nav><ul><li><a href='/'>Home</a></li><li><a href='/x'>News</a></li></ul></nav>{A * 2}<br><br>{B * 2}"
        "<div class='comments'><p>I liked it.</p></div></body></html>", "just text"])
    a3, b3 = " ".join([a] * 3), " ".join([b] * 3)
    assert got == ["text text", f"{a} {b}", a3, f"{a3}\n{b3}", " ".join([a, a, b, b]), "just text"]
