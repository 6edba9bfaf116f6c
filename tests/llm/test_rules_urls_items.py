import re
from collections import Counter

import duckdb
import pytest

from readloom.llm.contamination import contained_items, folded
from readloom.llm.line_rules import quality_rules, repeated_words
from readloom.llm.queries import ORACLES, QUERIES, URL_RULES
from readloom.llm.url_rules import judge_urls

from .helpers import SF, documents, sf_texts, words

CLEAN = "The first line of a clean text says a thing or two about nothing much.\nThe second line goes on in the same manner, and ends as it should.\n"
MORE = CLEAN + "A third line follows the second one, so that what surrounds the text is a small part.\n"
TEXTS = {
    1: None,
    2: "",
    3: CLEAN,
    4: MORE + "Home | About | Contact | Imprint | Help\nAll rights reserved.\n",
    5: "Home | About | Contact | Imprint | Help\n" * 9 + CLEAN,
    6: "word " * 400,
    7: "\n".join(["a line that is said again and again in it"] * 30),
    8: "STOP!! NOW!! READ!! THIS!! OR!! REGRET!! IT!!\n" * 3 + "SO!! IT!! GOES!! ON!! FOR!! EVER!! AND!! EVER!!",
    9: CLEAN * 3000,
    10: "é　x \x0b\x0c y" * 10,
}


def base(text):
    w = words(text)
    runs = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    many = Counter(runs)
    covered = {j for i, r in enumerate(runs) if many[r] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered), failed)


def stats(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_rules(spark):
    got = {r.doc_id: r for r in quality_rules(documents(spark, TEXTS)).collect()}
    assert {i: stats(r) for i, r in got.items()} == {i: base(t) for i, t in TEXTS.items()}
    assert [i for i, r in sorted(got.items()) if r.kept] == [3, 4]
    assert got[4].clean_text == MORE and (got[4].n_navigation, got[4].n_boilerplate) == (1, 1)
    assert got[1].clean_text == "" and got[5].n_navigation == 9
    assert quality_rules(documents(spark, TEXTS).limit(0)).count() == 0


def test_boilerplate_takes_no_paragraph(spark):
    paragraph = "You can read more about what the village was like before the river rose, since " + " ".join(f"witness{i} told us about day {i}" for i in range(20)) + "."
    phrases = "Privacy policy Terms of use Click here Read more " * 12
    notice = "Click here to sign in to this site and read more on our privacy policy or what we call our newsletter and share this"
    texts = {1: paragraph, 2: f"{paragraph}\nAll rights reserved.", 3: f"{notice}.", 4: f"{phrases}\n{CLEAN}", 5: f"{notice[:60]}\nSome words that are said to follow a notice of one line here.", 6: f"{notice}\n{CLEAN}"}
    got = {r.doc_id: r for r in quality_rules(documents(spark, texts)).collect()}
    assert got[1].kept and got[1].clean_text == paragraph and got[1].n_boilerplate == 0
    assert got[2].kept and got[2].clean_text == paragraph and got[2].lost_percent == 0
    assert not got[3].base_failed and not got[3].kept and got[3].lost_percent > 30
    assert got[4].n_boilerplate == 1 and not got[4].kept and got[4].lost_percent > 50
    assert got[5].n_boilerplate == 1 and not got[5].kept and got[5].lost_percent > 30
    assert got[6].n_boilerplate == 1 and not got[6].kept and got[6].lost_percent > 30


def test_repeated_windows():
    assert repeated_words([b"a"] * 9, 8) == 9
    assert repeated_words([b"%d" % (i % 10) for i in range(21)], 8) == 21
    assert repeated_words([b"%d" % i for i in range(30)], 8) == 0


def test_rules_query(spark):
    texts = sf_texts(spark)
    rows = QUERIES["op10_line_rules"](spark, SF).collect()
    assert {r.doc_id: stats(r) for r in rows} == {i: base(t) for i, t in texts.items()}
    assert not any(r.kept and r.base_failed for r in rows)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    assert sum(r.kept for r in rows if r.doc_id in good) > 0.9 * len(good)


def test_urls(spark):
    urls = [None, "", "no scheme", "http://EXAMPLE.org/es/x?q#f", "https://www.example.org/en/1", "https://xexample.org/es/", "http://a.b.com/de/?x", "http://org", "http://org/", "x://y://z.org/a", "http://", "http://.org/", "http://ex.com:80/fr/", "http://a.com/fr/\n#", "http://ü.org/"] + ["http://hot.com/de/%d" % i for i in range(3000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 as host", "2 as rule", "3 as `range`")
    rules = spark.createDataFrame([*URL_RULES, ("hot.com", "/de/1", "allow"), ("hot.com", "/de/12", "block"), ("hot.com", "/de/12", "allow"), (None, "/", "block")], "host string, path string, verdict string")

    def plain(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(r.host + r.path), r.verdict, r.host + r.path) for r in rules.dropna().collect() if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        _, verdict, rule = max(fits, default=(0, "allow", None))
        return host, path, rule, verdict

    known = {u: plain(u) for u in urls[:15]}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert len(got) == len(urls)
    assert [got[i] for i in range(15)] == [known[u] for u in urls[:15]]
    assert (got[15 + 12][2:], got[15 + 13][2:], got[15 + 2][2:]) == (("hot.com/de/12", "block"), ("hot.com/de/1", "allow"), ("com/de/", "block"))
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_items(spark):
    item = "Some test item, with just about twelve words in its one sentence."
    near = item.replace("twelve", "eleven")
    texts = {1: None, 2: "", 3: f"{CLEAN * 50} {item.upper()} {CLEAN}", 4: CLEAN, 5: near, 6: "yes and no", 7: "it said: YES, and no more", 8: item, 9: CLEAN * 2000 + item}
    bench = spark.createDataFrame([(1, item), (2, None), (3, "..."), (4, "yes and no"), (5, item + " " + item)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in contained_items(documents(spark, texts), bench).collect())
    assert got == [(3, 1), (6, 4), (7, 4), (8, 1), (9, 1)]
    assert contained_items(documents(spark, texts).limit(0), bench).count() == 0
    assert contained_items(documents(spark, texts), bench.limit(0)).count() == 0
    halves = [contained_items(documents(spark, [item]), bench, percent=p).filter("item_id = 5").count() for p in (60, 80)]
    assert halves == [1, 0]
    assert folded(b"A-b.C") == [b"a", b"b", b"c"]


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    one = sorted(map(tuple, contained_items(docs, bench).collect()))
    monkeypatch.setattr("readloom.llm.contamination.BLOCK_SHINGLES", 300)
    assert sorted(map(tuple, contained_items(docs, bench).collect())) == one and one


@pytest.mark.parametrize("name", ["op5_url_rules", "op9_contamination"])
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), c.sql(ORACLES[name]).df()[QUERIES[name](spark, SF).columns]
    rows = lambda df: sorted(map(str, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
