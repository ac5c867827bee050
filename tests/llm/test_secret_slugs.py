import random
import string
import time

import pytest

from broadsheet.llm import secret_scan

WORDS = "quick brown fox jumps over lazy dog while editors publish long headlines about politics economy climate culture science travel health opinion sports weather markets".split()


def slug(n, tail="", joiner="-"):
    return "https://news.example/" + joiner.join(WORDS[i % len(WORDS)] for i in range(n)) + tail


@pytest.mark.parametrize("tail", ["", "-2024", "2024x", "-2024-05/page2", "/2024/05/17/", "=", "-A1b2"])
def test_long_slugs_are_linear(tail):
    for n in (16, 24, 2000):
        began = time.perf_counter()
        secret_scan.scan(slug(n, tail))
        assert time.perf_counter() - began < 1


@pytest.mark.parametrize("n", [4, 10, 16, 20, 24, 100, 2000])
@pytest.mark.parametrize("tail", ["", "-2024", "-2024-05/page2", "/2024/05/17/index"])
@pytest.mark.parametrize("joiner", ["-", "_", "/"])
def test_plain_slugs_are_no_secrets(n, tail, joiner):
    assert secret_scan.scan(slug(n, tail, joiner)) == []


def test_random_keys_are_found_beside_slugs():
    r, hit = random.Random(5), 0
    for _ in range(400):
        key = "".join(r.choice(string.ascii_letters + string.digits + "+/") for _ in range(40))
        text = f"{slug(12)} {key} {slug(20, '-2024')}"
        at = text.index(key)
        hit += any(a < at + 40 and b > at for a, _, b, k in secret_scan.scan(text) if k.startswith("entropy"))
    assert hit >= 396
    for _ in range(400):  # and in a path between words
        key = "".join(r.choice(string.ascii_letters + string.digits) for _ in range(40))
        text = f"https://host.example/download/{key}/file-name"
        hit += any(k.startswith("entropy") for *_, k in secret_scan.scan(text))
    assert hit >= 792


def test_urls_of_pages(spark):
    urls = [r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").collect()]
    assert sum(bool(secret_scan.scan(u or "")) for u in urls) == 0
