import math
import re
import textwrap

from pyspark.sql import functions as F

from tidemark.llm import licenses, urls

URLS = ["https://a.example.org/es/5", "http://example.org/en/12?x", "http://example.org/en/2",
        "https://X.COM/fr/1#t", "https://b.com/de/", "https://org", "https://org/", "ftp://a.b/c",
        "http://notorg/", None, "", "no scheme", "http://?q", "http://u@h:80/p?/x://y",
        "x://y://z/w", "http://ÄB.com/fr/", "https://a.com/FR/1", "HTTP://A.NET/\nb?c"]


def plain_url(url):
    rest = url.partition("://")[2] if url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in urls.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith(r[r.index("/"):])]
    return host, path, max(fits, key=len) if fits else None


def best_split(label, split):
    """The cheapest of all splits."""
    if not label:
        return 0.0, []
    options = []
    for n in range(1, len(label) + 1):
        cost, rest = best_split(label[n:], split)
        own = split.cost.get(label[:n], split.unseen(n))
        options.append((own + cost, [label[:n], *rest]))
    return min(options)


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    out = df.select("url", urls.host_of("url").alias("h"), urls.path_of("url").alias("p"))
    out = out.withColumn("r", urls.rule_of(F.col("h"), F.col("p")))
    for r in out.collect():
        assert (r["h"], r["p"], r["r"]) == plain_url(r["url"]), r["url"]


def test_segmentation_is_the_cheapest():
    split = urls.Segmenter({"the": 50, "re": 20, "there": 9, "in": 30, "ring": 4, "a": 5}, 200)
    for label in ("there", "therein", "thering", "rere", "zzthe", "q", "inthearing"):
        assert math.isclose(sum(split.cost.get(w, split.unseen(len(w))) for w in split.split(label)),
                            best_split(label, split)[0])
    assert split.split("thein") == ["the", "in"]


def test_judge(spark):
    pages = spark.createDataFrame(
        [(i, u, "<p>cheap pills the spam farm there</p>" if i % 2 else None)
         for i, u in enumerate(URLS * 3 + ["https://cheappills.net/x", "https://there.net/x"])],
        "page_id long, url string, html string").repartition(3)
    model = urls.learn(pages)
    assert model.segmenter.split("cheappills") == ["cheap", "pills"]
    out = {r["url"]: r for r in urls.judge(pages, model).collect()}
    assert urls.judge(pages, model).count() == pages.count()
    for r in out.values():
        _, _, rule = plain_url(r["url"])
        assert r["verdict"] == (urls.RULES[rule] if rule else
                                "block" if r["p_block"] > 0.5 else "allow")
        assert math.isclose(r["p_block"], model.score(r["host"], r["path"]))
    assert out["https://cheappills.net/x"]["p_block"] > out["https://there.net/x"]["p_block"]
    none = pages.limit(0)
    assert urls.judge(none, urls.learn(none)).count() == 0
    extra = pages.withColumns({c: F.lit("x") for c in ("host", "path", "rule", "word", "n")})
    assert urls.judge(extra.select("page_id", "url"), urls.learn(extra)).count() == pages.count()


def plain_bayes(pages, split):
    """Probability of block of (host, path) by counting in a dictionary."""
    words, n_pages = {"allow": {}, "block": {}}, {"allow": 0, "block": 0}
    for url in pages:
        host, path, rule = plain_url(url)
        if rule:
            n_pages[urls.RULES[rule]] += 1
            for t in urls.tokens(host, path, split):
                own = words[urls.RULES[rule]]
                own[t] = own.get(t, 0) + 1
    n_block = sum(words["block"].values())
    for seed in urls.SEEDS:
        words["block"]["h:" + seed] = words["block"].get("h:" + seed, 0) + max(
            1.0, urls.SEED_SHARE * n_block)
    known = set(words["allow"]) | set(words["block"])

    def score(host, path):
        logs = {}
        for v in words:
            mass = sum(words[v].values()) + len(known) + 1
            logs[v] = math.log(n_pages[v] + 1) + sum(
                math.log((words[v].get(t, 0) + 1) / mass) for t in urls.tokens(host, path, split))
        return 1 / (1 + math.exp(max(-40, min(40, logs["allow"] - logs["block"]))))
    return score


def test_naive_bayes_is_that_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = urls.learn(pages)
    score = plain_bayes([r["url"] for r in pages.select("url").collect()], model.segmenter)
    for r in urls.judge(pages.select("url"), model).collect():
        assert math.isclose(r["p_block"], score(r["host"], r["path"]), rel_tol=1e-6)


def test_held_out_pages_get_their_rule_s_verdict(spark):
    """The classifier alone, on rule-decided pages whose verdicts it has not seen."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    held = F.crc32(F.col("page_id").cast("string").cast("binary")) % 4 == 2
    model = urls.learn(pages.filter(~held))
    out = urls.judge(pages.filter(held).select("page_id", "url"), model).filter("rule is not null")
    said = out.withColumn("said", F.col("p_block") > 0.5).withColumn(
        "block", F.col("verdict") == "block").groupBy("block").agg(
        F.avg(F.col("said").cast("double")).alias("share"), F.count("*").alias("n")).collect()
    share = {r["block"]: r["share"] for r in said}
    assert min(r["n"] for r in said) > 40
    assert share[True] >= 0.9 and share[False] <= 0.05, share


def test_words_of_all_scripts_and_lengths(spark):
    long = "donaudampfschifffahrtsgesellschaftskapitaensmuetze"
    html = (f"<script>var hidden = 1;</script><p class='markup'>réseau {long} сеть&nbsp;réseau</p>"
            "<!-- comment -->")
    pages = spark.createDataFrame([(1, "http://x.net/", html)] * 3,
                                  "page_id long, url string, html string")
    split = urls.segmenter(pages)
    assert {"réseau", "reseau", "сеть", long} <= set(split.cost)
    assert not {"hidden", "markup", "comment", "p", "script"} & set(split.cost)
    assert split.split(f"reseau{long}сеть") == ["reseau", long, "сеть"]
    assert split.split("q" * 5000) == ["q" * 5000]
    assert urls.tokens("сеть.рф", "/ñ/12", split)[:2] == ["h:сеть", "h:рф"]


def plain_matches(text):
    out = []
    for i, line in enumerate([text or "", *(text or "").split("\n")]):
        words = re.sub("[^a-z0-9]+", " ", line.lower()).strip().split(" ")
        grams = {f"{a} {b}" for a, b in zip(words, words[1:])}
        scored = []
        for name, notice in licenses.TEMPLATES.items():
            own = set(licenses.template_bigrams(notice))
            dice = 2 * len(grams & own) / (len(grams) + len(own))
            if dice >= licenses.MIN_DICE:
                scored.append((-dice, name))
        if scored:
            out.append((i, min(scored)[1], -min(scored)[0]))
    return out


def test_license_lines(spark, docs, rows, no_docs):
    notices = list(licenses.TEMPLATES.values())
    texts = [r[1] for r in rows] + notices + [
        "\n".join(notices), notices[0].upper() + "!!", "x\n\n" + notices[3] + "\n" + notices[3],
        "Released%%% under*** the&&& MIT### License.", "the mit license", "released under the mit "
        "licence or so they say", " ".join(notices), ("under the " * 300) + notices[5],
        "MIT MIT MIT MIT", "a b", "Copyright (c) 2020 A. Person\n\n" + notices[1]]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    seen = set()
    for r in df.select("text", licenses.line_matches("text").alias("m")).collect():
        got = [(m["line"], m["license"], m["dice"]) for m in r["m"]]
        want = plain_matches(r["text"])
        assert [g[:2] for g in got] == [w[:2] for w in want], r["text"]
        assert all(math.isclose(g[2], w[2]) for g, w in zip(got, want))
        seen |= {(g[0] == 0, g[1]) for g in got}
    assert {(True, "MIT+"), (False, "MIT"), (True, "ISC+"), (False, "GPL-3.0")} <= seen
    assert no_docs.select(licenses.line_matches("text")).count() == 0


def test_size_bounds_lose_nothing():
    for m in range(1, 30):
        low, high = licenses.size_bounds(m, 0.8)
        for n in range(1, 60):
            reachable = 2 * min(n, m) / (n + m) >= 0.8 - 1e-12
            assert reachable == (low <= n <= high)


def test_licenses_run_without_python(spark, docs):
    plan = docs.select(licenses.line_matches("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_passages(text):
    """Every window of every template; of overlapping ones the best."""
    words = [(w, i) for i, line in enumerate(text.split("\n"), 1)
             for w in re.sub("[^a-z0-9]+", " ", line.lower()).split()]
    grams = [f"{a[0]} {b[0]}" for a, b in zip(words, words[1:])]
    found = []
    for name, notice in licenses.TEMPLATES.items():
        own = set(licenses.template_bigrams(notice))
        most = int(licenses.MOST_WORDS * len(licenses.template_words(notice))) - 1
        for a in range(len(grams)):
            if grams[a] in own:
                seen, best = set(), (0.0, 0)
                for b in range(a, min(len(grams), a + most)):
                    seen.add(grams[b])
                    best = min(best, (-2 * len(seen & own) / (len(seen) + len(own)), b))
                if -best[0] >= licenses.MIN_DICE:
                    found.append((best[0], name, a, best[1] + 1))
    kept = []
    for f in sorted(found):
        if all(f[3] < k[2] or k[3] < f[2] for k in kept):
            kept.append(f)
    return [(words[a][1], words[b][1], name, -less)
            for less, name, a, b in sorted(kept, key=lambda k: k[2])]


def test_license_passages(spark, tmp_path):
    other = [f"other{i}" for i in range(400)]
    wrapped = textwrap.fill(" ".join(licenses.TEMPLATES["MIT+"].split()), 78)
    inline = "We ship this tool to all users today. Released under the MIT License. See the docs."
    texts = [wrapped + "\n" + " ".join(other), " ".join(other[:200]) + "\n" + wrapped + "\n\n"
             + " ".join(other[200:]), inline, "all parts are\nreleased under the\nMIT license, as "
             "told", "Released under the MIT License.", " ".join(licenses.TEMPLATES.values()),
             "x " * 50 + wrapped.replace("WARRANTY", "promise") + " y" * 50, "", "mit", None,
             "\n\n mit of the software\n" * 30, inline + "\n" + inline.replace("MIT", "ISC")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["m"] for r in
           df.select("doc_id", licenses.passage_matches("text").alias("m")).collect()}
    for i, text in enumerate(texts):
        want = plain_passages(text or "")
        assert [tuple(m)[:3] for m in got[i]] == [w[:3] for w in want], text
        assert all(math.isclose(m["dice"], w[3]) for m, w in zip(got[i], want))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in licenses.op4_license_scan(spark, str(tmp_path)).collect()}
    lines = wrapped.count("\n") + 1
    assert out[0]["matches"] == f"1-{lines}:MIT+" and out[1]["matches"] == f"2-{lines + 1}:MIT+"
    assert out[2]["matches"] == "1-1:MIT" and out[3]["matches"].endswith("2-3:MIT")
    assert out[4]["matches"] == "0:MIT,1:MIT"  # not told twice
    assert out[11]["matches"] == "1-1:MIT,2-2:ISC" and out[9]["n_matches"] == 0


def test_needed_words_lose_nothing():
    needed = set(licenses.needed_words(licenses.TEMPLATES, licenses.MIN_DICE))
    for notice in licenses.TEMPLATES.values():
        grams = licenses.template_bigrams(notice)
        left = [g for g in grams if not needed & set(g.split(" "))]
        assert len(left) < licenses.least_common(len(grams), licenses.MIN_DICE)
