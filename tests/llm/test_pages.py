"""Operators over pages, and the pipeline."""

import html
import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from corpus_helpers import frame
from rulemark.llm import decontamination, html_text, url_filter

SF = "/root/testdata/sf0.001"


def pages(spark, rows):
    schema = "page_id bigint, url string, html string, host string, row string, template string, token string"
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema)


def extracted(spark, sources):
    rows = [(i, f"http://h.example/{i}", s) for i, s in enumerate(sources)]
    return {r["page_id"]: r["text"] for r in html_text.extract(pages(spark, rows)).collect()}


def brute_text(page):
    """The generator's pages: an article of paragraphs, some left open."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", body)
    texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<(b|br)>", lambda m: " " if m[1] == "br" else "", p))).strip() for p in parts]
    return "\n\n".join(t for t in texts if t)


def test_table(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r["page_id"]: r for r in html_text.extract(table).collect()}
    for r in table.collect():
        text = brute_text(r["html"])
        assert found[r["page_id"]]["text"] == text and found[r["page_id"]]["n_chars"] == len(text)
        assert found[r["page_id"]]["url"] == r["url"]


def test_parts_of_a_page(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
    <nav>Menu <a href=x>a</a></nav><div class="cookie-notice">We use cookies</div>
    <article><header><h1>Head &amp; line</h1></header><p>One <b>two</b>
      three<p>Four<br>five<script>var a = "</p><p>no";</script> six<aside>side</aside>
    <form><input>send</form><ul><li>item<li>other &lt;b&gt; &#233;</ul><!-- <p>gone</p> -->
    <div id=ad>buy</div><section class="comments"><p>reader</p></section></article><footer>foot</footer></body></html>"""
    assert extracted(spark, [page])[0] == "Head & line\n\nOne two three\n\nFour five six\n\nitem\n\nother <b> é"


@pytest.mark.parametrize(
    "page",
    [
        "<body><script>if (a<b) { c() }</script><article><p>Text</p></article>",
        "<body><script>s = '<!-- x'</script><article><p>Text</p></article>",
        "<body><style>a>b{content:'<p>'}</style><article>Te<SCRIPT>'</p>'</Script >xt</article>",
        "<body class='has-sidebar menu'><div class='with-nav no-ads'><article id='comment'><p>Text</p></article></div>",
        "<article><p>Text</p><script>never closed <p>no</p></article>",
    ],
)
def test_scripts_and_names_that_look_like_markup(page):
    assert html_text.main_text(page, frozenset()) == "Text"


def test_headings_keep_their_anchors():
    page = "<article><h2 id='search'>Search</h2><p>by a &lt; b</p><div id='comments'>reader</div></article>"
    assert html_text.main_text(page, frozenset()) == "Search\n\nby a < b"


def test_templates_where_there_is_no_article(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") * 4 for _ in range(9)) for _ in range(12)]
    made = [f"<html><body><div>Welcome to us</div><div><p>{t}</p></div><div>All rights</div><div>Call us</div></body></html>" for t in texts]
    found = extracted(spark, made)
    assert [found[i] for i in range(12)] == texts


@pytest.mark.parametrize("names", ["id='related-work'", "class='side-effects'", "id='search-algorithms'", "class='lunch menu'", "class='x-share y'"])
def test_names_in_an_article_are_no_evidence(spark, names):
    page = f"<body><nav>m</nav><article><p>One</p><section {names}><p>Two</p></section><div class='comments'>reader</div></article></body>"
    assert extracted(spark, [page])[0] == "One\n\nTwo"


def test_elements_that_the_template_has_are_left_out_of_articles(spark):
    """A box with a telling name in every article, and a line that each article repeats."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") * 5 for _ in range(8)) for _ in range(10)]
    shared = "a passage that many pages share"
    made = [
        f"<body><article><h1>t{i}</h1><p>{t}</p>{f'<p>{shared}</p>' if i % 2 else ''}<p>Never miss a story!</p>"
        f"<div class='box related-links'><p>{texts[i - 1]}</p></div></article></body>"
        for i, t in enumerate(texts)
    ]
    found = extracted(spark, made)
    assert found == {i: f"t{i}\n\n{t}" + (f"\n\n{shared}" if i % 2 else "") for i, t in enumerate(texts)}


def test_a_teaser_is_not_the_article(spark):
    body = "long words of the page " * 20
    page = f"<body><nav>m</nav><div id='content'><p>{body}</p></div><article><p>Read next</p></article><footer>f</footer></body>"
    assert extracted(spark, [page])[0] == body.strip()


def brute_templates(made):
    """Templates from whole occurrence vectors: host -> tokens."""
    hosts = defaultdict(list)
    for host, page in made:
        hosts[host].append(html_text.tokens_of(page))
    out = {}
    for host, counts in hosts.items():
        vectors = defaultdict(list)
        for token in {t for c in counts for t in c}:
            vectors[tuple(c.get(token, (0, 0))[0] for c in counts)].append(token)
        kind = {t: k for c in counts for t, (_, k) in c.items()}
        for vector, tokens in vectors.items():
            n = sum(v > 0 for v in vector)
            around = [t for t in tokens if kind[t] != html_text.WITHIN]
            if n >= html_text.LEAST_PAGES and n >= html_text.SUPPORT * len(counts) and len(around) >= html_text.CLASS_SIZE:
                fixed = n == len(counts) >= html_text.LEAST_FIXED and any(kind[t] == html_text.OPENING for t in tokens)
                out.setdefault(host, set()).update(tokens if fixed else around)
    return out


def test_classes_by_whole_vectors(spark):
    rng = random.Random(12)
    made = []
    for i in range(90):
        host = f"h{rng.randrange(5)}.example"
        parts = [f"<div><p>{rng.choice(['a', 'b', 'c'])}</p></div>" * rng.randint(0, 2) for _ in range(3)]
        article = f"<article><p>{rng.choice('xyz')}</p>" + "<p>always</p>" * (host != "h1.example" or i % 3 > 0) + "<section class='more share'>s</section></article>"
        made.append((host, f"<html><body>{parts[0]}<nav><p>menu</p></nav>{article}{parts[1]}<footer>f</footer>{parts[2]}</body></html>"))
    rows = [(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(made)]
    got = {r["host"]: set(r["template"]) for r in html_text.templates(pages(spark, rows)).collect()}
    assert got == brute_templates(made) and len(got) == 5


def test_repeated_articles_stay(spark):
    page = "<body><nav>m</nav><article><h1>Same</h1><p>words everywhere</p></article></body>"
    assert set(extracted(spark, [page] * 30).values()) == {"Same\n\nwords everywhere"}


def test_odd_pages(spark):
    long = "<p>" + "word " * 100_000
    made = [None, "", "plain text", "<p>open", "<article><p>cut off <b", "</p></div>x", "<article>" + "<div>" * 2000 + "deep", long, "<script>never closed <p>x"]
    found = extracted(spark, made)
    assert [found[i] for i in (0, 1, 2, 3, 8)] == ["", "", "plain text", "open", ""]
    assert found[4].startswith("cut off") and found[6] == "deep" and found[5] == "x" and len(found[7]) == 499_999
    assert html_text.extract(pages(spark, [])).count() == 0


# urls


def brute_rule(host, path):
    fitting = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fitting, key=lambda x: len(x[0]), default=(None, None))


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
    return "".join(c.lower() if c < "\x80" else c for c in host), path


URLS = [
    None, "", "no scheme", "http://", "HTTP://Com/", "http://a.com", "http://a.com/x", "http://Example.COM/en/1?q#f", "http://www.example.com/en/",
    "http://x.www.example.com/en/y", "http://notexample.com/en/", "http://a.net/es/", "https://a.net/fr/x", "https://a.net/de/", "http://a.net?x=/es/",
    "http://É.net/es/1", "x://y://a.com/z", "http://user@a.com:80/", "http://a.org/en/#/es/", "http://a.com/\n/x",
]


def test_rules(spark):
    rows = [(i, u, "") for i, u in enumerate(URLS)] + [(3, URLS[3], ""), (None, None, None)]
    found = url_filter.filter_urls(pages(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        url = URLS[r["page_id"]] if r["page_id"] is not None else None
        host, path = brute_parts(url)
        rule, verdict = brute_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == (verdict or "allow")
    assert url_filter.filter_urls(pages(spark, [])).count() == 0


def test_trust_and_distrust_run_along_links(spark):
    link = lambda *hosts: "".join(f'<a href="https://{h}/x">l</a>' for h in hosts)
    rows = [(0, "http://good.com/a", link("friend.org")), (1, "http://bad.example.com/en/1", "")]
    rows += [(2, "http://friend.org/", link("bad.example.com")), (3, "http://farm.org/", link("bad.example.com")), (4, "http://alone.org/", "")]
    rows += [(5, "http://far.org/", link("farm.org"))]
    found = {r["page_id"]: r for r in url_filter.filter_urls(pages(spark, rows)).collect()}
    assert {i: found[i]["verdict"] for i in found} == {0: "allow", 1: "block", 2: "allow", 3: "block", 4: "allow", 5: "block"}
    # against plain iteration
    edges = {"trust": Counter(), "distrust": Counter()}
    for _, url, page in rows:
        src = brute_parts(url)[0]
        for dst in re.findall(r"https://([^/]+)", page):
            edges["trust"][(src, dst)] += 1
            edges["distrust"][(dst, src)] += 1
    seeds = {"trust": ["good.com"], "distrust": ["bad.example.com"]}
    for kind, graph in edges.items():
        out = defaultdict(int)
        for (a, _), n in graph.items():
            out[a] += n
        rank = {s: 1.0 for s in seeds[kind]}
        for _ in range(url_filter.ROUNDS):
            new = defaultdict(float, {s: 1 - url_filter.DAMPING for s in seeds[kind]})
            for (a, b), n in graph.items():
                new[b] += url_filter.DAMPING * rank.get(a, 0) * n / out[a]
            rank = new
        for i, (_, url, _) in enumerate(rows):
            assert found[i][kind] == pytest.approx(rank.get(brute_parts(url)[0], 0.0))


# pipeline


def test_pipeline(spark, tmp_path, texts):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    item = bench.first()["text"]
    more = [(600, "Before it. " + item + " After it, more words follow here.", "en"), (601, "!!! 123", "en")]
    frame(spark, texts + more).write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        after.write.parquet(str(tmp_path / f"s{len(kept)}"))
        docs = spark.read.parquet(str(tmp_path / f"s{len(kept)}"))
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert not {400, 401, 402, 403, 404, 601} & kept[0] and set(range(60)) <= kept[0]
    assert not set(range(200, 209)) & kept[1] and 3 in kept[1] and 407 not in kept[1]
    assert kept[2] & set(range(300, 340)) == {300}
    assert kept[2] - kept[3] == {600}
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in found if not r["start"]) == Counter(r["doc_id"] for r in docs.select("doc_id").collect())


def test_pipeline_of_an_empty_table(spark, tmp_path, empty):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert decontamination.answer_of("One. Two words here. Yes.") == 4
