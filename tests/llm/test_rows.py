"""Top-k, personal data, toxicity, URL filters, WARC records and the pipeline against plain Python."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import random
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, prose
from timberline.llm import packing, pii, topk, toxicity, urls, warc
from timberline.session import materialize

# --- top-k


def vectors():
    draw = random.Random(1)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(8)], "x") for i in range(260)]
    rows += [(300, None, "x"), (350, [], "x"), (400, [1.0, None] + [0.0] * 6, "x"), (450, [math.nan] + [0.0] * 7, "x"), (None, [1.0] * 8, "x")]
    rows += [(500, [math.inf] + [0.0] * 7, "x"), (550, [1.0, 2.0], "x"), (551, [0.5, 0.5], "x"), (600, [2.0] * 3, "x")]
    rows += [(700, [0.25] * 8, "x"), (701, [0.5] * 8, "x"), (702, [0.5] * 8, "x"), (702, [0.5] * 8, "x"), (703, [0.5] * 8, "x")]
    return rows


def brute_top(rows, k):
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in good:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i and len(w) == len(v))
            out += [(i, rank + 1, j, -score) for rank, (score, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,fan_in,block_rows", [(4096, 16, 4096), (7, 2, 2)])
def test_top_k(spark, monkeypatch, shard_rows, fan_in, block_rows):
    for name, value in (("SHARD_ROWS", shard_rows), ("FAN_IN", fan_in), ("BLOCK_ROWS", block_rows)):
        monkeypatch.setattr(topk, name, value)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(5)
    assert sorted(map(tuple, topk.top_k(table, 5).collect())) == brute_top(rows, 5)


def test_top_k_of_an_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


# --- personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        weighed = [int(c) if i % 2 == 0 else int(c) * 2 % 10 + int(c) * 2 // 10 for i, c in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(weighed) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, p in BASE.items() for m in re.finditer(p, text or "") if passes(kind, m.group())]


PRIVATE = [
    "a@b.c_d@e.f a@b@c.d x.y+z@host-1.example.com.",
    "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1 1.1.1.99999999999999999999 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4799134681044206 12 34 5",
    "+1 (744) 555-2801 + 1 +12 +123456789 +1234567890123456 +1 2.3(4)5-6 7 8 9",
    "\U0001f600 ä@b.de mail: jane.doe@example.org, tel +49 30 1234567",
    "1" * 30_000 + " " + "a.b" * 10_000 + " " + "@a.b" * 2000,
    "+1 2" + " 3" * 20_000 + " end",
]


def test_base_spans(docs_of):
    docs = [*ODD, *((50 + i, text) for i, text in enumerate(PRIVATE))]
    got = pii.found(docs_of(docs).select("doc_id", "text")).select("doc_id", pii.joined(F.col("base")).alias("base")).collect()
    assert sorted((row.doc_id or -1, row.base) for row in got) == sorted((i or -1, ",".join(base_spans(text))) for i, text in docs)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(st.sampled_from("12a@.+- ()é"), max_size=30), min_size=20, max_size=20))
def test_base_spans_of_any_text(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = pii.with_base(table).select("doc_id", pii.joined(F.col("_base")).alias("base")).collect()
    assert {row.doc_id: row.base for row in got} == {i: ",".join(base_spans(text)) for i, text in enumerate(texts)}


def test_private_data_query(spark, small_dir):
    rows = pii.op7_pii(spark, small_dir).collect()
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    for row in rows:
        base = base_spans(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(x.startswith(kind + ":") for x in base) for kind in BASE]
        assert row.spans.split(",")[: len(base)] == base or not base


def secrets():
    draw = random.Random(5)
    hexa = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    docs = []
    for i in range(300):
        more = [f"password={hexa(16)}", f'token = "{hexa(40)}"', f"u{i}@mail.example.com", f"10.0.{i % 256}.7", f"+1 (555) 555-{1000 + i}", f"{draw.randint(0, 99999)}"][i % 6]
        docs.append((i, f"{prose(i, 20)} {more} {prose(i + 1000, 20)}"))
    return docs


def test_trees_add_secrets_and_leave_words_alone(docs_of):
    docs = secrets()
    rows = {row.doc_id: row.spans for row in pii.found(docs_of(docs).select("doc_id", "text")).select("doc_id", pii.joined(F.col("spans")).alias("spans")).collect()}
    assert np.mean(["secret" in rows[i] for i in rows if i % 6 < 2]) > 0.9
    assert np.mean([rows[i] == "" for i in rows if i % 6 == 5]) > 0.9
    assert all(rows[i] for i in rows if 2 <= i % 6 < 5)


def test_redaction_keeps_columns_and_the_rest_of_the_text(docs_of):
    docs = [*ODD, (50, "mail jane@example.org or +49 30 1234567 now"), (51, "a" * 50)]
    table = docs_of(docs).withColumn("n_chars", F.length("text").cast("long"))
    out = pii.redacted(table)
    assert out.columns == table.columns
    rows = {row.doc_id: row for row in out.collect()}
    assert rows[50].text == "mail [email] or [phone] now" and rows[50].n_chars == len(rows[50].text)
    assert rows[51].text == "a" * 50 and rows[1].text is None and rows[50].spans.startswith("spans-")
    assert rows[8].text == "x" * 300_000 and rows[7].text == dict(docs)[7]


def test_trees_learn_from_all_documents(spark, docs_of):
    # More documents than any sample: each has an address, and all words of it are learned from.
    docs = [(i, f"mail u{i % 7}@mail.example.com " + " ".join(["plain", "words"] * (i % 9))) for i in range(9_000)]
    rows = pii.training_rows(docs_of(docs).select("doc_id", "text"))
    weights = {(row.kind, row.label): row.weight for row in rows.groupBy("kind", "label").agg(F.sum("weight").alias("weight")).collect()}
    assert weights["email", 1.0] == weights["mail_like", 1.0] == len(docs)
    # "mail", the parts of the address and its name without digits, and the words that follow.
    words = [len(regex.findall(r"[^\s0-9]{4,}+", text)) for _, text in docs]
    assert weights["word", 0.0] == pytest.approx(sum(min(n, pii.PLAIN_WORDS) for n in words), rel=1e-4)
    assert rows.count() < 200
    assert pii.training_rows(docs_of([]).select("doc_id", "text")).count() == 0


def candidates(text):
    return sorted((kind, m.start(), m.end()) for kind, pattern in pii.GENERATORS.items() for m in regex.finditer(pattern, text))


GENERATED = [
    "password: correcthorse", "the Token = abcdefghijkl", "key ABCDEFGHIJKLMNOPQRST here", "abcdefabcdefabcdefabcdef", "john at example (dot) com",
    "john at example [dot] com", "JOHN AT EXAMPLE {DOT} COM", "john (at) example dot com", "john[at]example[dot]co[dot]uk", "ring 555 123 4567 now", "nothing at all", "dot",
]


def test_generators_are_tried_wherever_they_match(docs_of):
    docs = list(enumerate(GENERATED))
    rows = pii.with_candidates(pii.with_base(docs_of(docs).select("doc_id", "text"))).select("doc_id", "_more").collect()
    assert {row.doc_id: sorted((x.kind, x.start, x.end) for x in row._more) for row in rows} == {i: candidates(text) for i, text in docs}
    assert all(candidates(text) for text in GENERATED[:10])


def test_long_secrets_and_those_that_hold_a_base_span_go_whole(docs_of, monkeypatch):
    draw = random.Random(8)
    some = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    held = [f"token={some('abcXYZ019._-', 603)}", f'api_key: "{some("abcdef0123456789", 3000)}"', some("0123456789abcdef", 200), some("ABCXYZ019", 60), "password=ab12@x.y!rest", "pwd=+49 30 1234567"]
    docs = [(i, f"before {text} after") for i, text in enumerate(held)]
    monkeypatch.setattr(pii, "learned", lambda docs: pii.Scorer([], dict.fromkeys(pii.GENERATORS, 0.0)))  # all candidates pass
    rows = {row.doc_id: row.text for row in pii.redacted(docs_of(docs)).collect()}
    assert [rows[i] for i in range(5)] == ["before [secret] after"] * 5
    assert rows[5] == "before pwd=[phone] after"


def test_an_overlap_with_a_span_that_goes_does_not_count(spark):
    chains = {
        1: [("a", 0, 10, 3.0), ("a", 8, 20, 2.0), ("a", 18, 30, 1.0)],
        2: [("a", 0, 10, 1.0), ("a", 8, 20, 2.0), ("a", 18, 30, 1.5), ("b", 29, 35, 1.4), ("b", 30, 35, 0.1)],
        3: [("b", 0, 5, 1.0), ("a", 0, 5, 1.0), ("a", 5, 6, 0.5)],
        4: [],
    }
    table = spark.createDataFrame(list(chains.items()), "id int, spans array<struct<kind:string,start:long,end:long,margin:double>>")
    got = {row.id: [tuple(x) for x in row.left] for row in table.select("id", pii.undisputed("spans").alias("left")).collect()}
    assert got == {1: [chains[1][0], chains[1][2]], 2: [chains[2][1], chains[2][3]], 3: [chains[3][1], chains[3][2]], 4: []}


LENGTH_TREE = "If (feature 0 <= 14.0)\n Predict: 0.1\nElse (feature 0 > 14.0)\n Predict: 0.5"


def brute_added(text, least):
    base = [(kind, int(a), int(b)) for kind, a, b in (x.split(":") for x in base_spans(text))]
    free = [x for x in candidates(text) if not any(b[1] <= x[1] and x[2] <= b[2] for b in base)]
    scored = [(-(0.1 if x[2] - x[1] <= 14 else 0.5), x[1], x[0], x[2]) for x in free]
    taken = []
    for less, start, kind, end in sorted(x for x in scored if -x[0] >= least[x[2]]):
        if all(end <= a or b <= start for _, a, b in taken):
            taken.append((kind, start, end))
    order = list(pii.GENERATORS)
    return [f"{k}:{a}:{b}" for k, a, b in [*base, *sorted(taken, key=lambda x: (order.index(x[0]), x[1]))]]


def test_added_spans_against_plain_python(docs_of, monkeypatch):
    least = {"mail_like": 0.0, "number_like": 0.3, "secret": 0.0}
    monkeypatch.setattr(pii, "learned", lambda docs: pii.Scorer([(1.0, LENGTH_TREE)], least))
    docs = list(enumerate([*GENERATED, *PRIVATE, *(text for _, text in secrets()[:30])]))
    docs += [(900, "pwd=1234567 890 123 4567890 and 123 456 7890 x at y"), (901, "token: 5551234567890123 at ab (dot) cd"), (902, None)]
    rows = {row.doc_id: row.spans for row in pii.found(docs_of(docs).select("doc_id", "text")).select("doc_id", pii.joined(F.col("spans")).alias("spans")).collect()}
    assert rows == {i: ",".join(brute_added(text or "", least)) for i, text in docs}


def test_long_addresses_and_numbers_are_not_cut(docs_of, monkeypatch):
    monkeypatch.setattr(pii, "learned", lambda docs: pii.Scorer([], dict.fromkeys(pii.GENERATORS, 0.0)))
    address = "a.long-name" * 6 + " at " + "host" * 15 + " dot " + "part" * 9 + " dot x1 dot y2 dot z3 dot v4 dot w5"
    docs = [(1, f"write to {address}, now"), (2, "no " + "7" * 30 + " end"), (3, "no " + "7 1" * 25 + " end")]
    rows = {row.doc_id: row.text for row in pii.redacted(docs_of(docs)).collect()}
    assert rows == {1: "write to [mail_like], now", 2: "no [number_like] end", 3: "no [number_like] end"}


def test_columns_of_the_same_names(spark):
    names = ["_tried", "_base", "_found", "_more", "_passed", "base", "spans", "_row"]
    table = spark.createDataFrame([(1, "mail a@b.de", *names)], ", ".join(["doc_id long, text string", *[f"{name} string" for name in names]]))
    row = pii.found(table).first().asDict()
    assert [row[name] for name in ("_tried", "_base", "_found", "_more", "_passed", "_row")] == ["_tried", "_base", "_found", "_more", "_passed", "_row"]
    assert len(row["base"]) == len(row["spans"]) == 1


def test_private_data_of_an_empty_table(docs_of):
    assert pii.redacted(docs_of([])).collect() == []


# --- toxicity


def brute_segments(places, scores, size, drift):
    """Ruzzo and Tompa's definition: the best segment, then the same on both sides of it."""
    each = np.full(size, -drift)
    each[places] = scores
    out = []

    def split(a, b):
        best, where = 0.0, None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += each[j]
                if total > best + 1e-9:
                    best, where = total, (i, j + 1)
        if where:
            split(a, where[0])
            out.append((*where, best))
            split(where[1], b)

    split(0, size)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 1, 2, 5]), max_size=24))
def test_segments(scores):
    places = [i for i, x in enumerate(scores) if x]
    got = toxicity.segments(places, [scores[i] + i * 1e-4 for i in places], 1.003)
    want = brute_segments(places, [scores[i] + i * 1e-4 for i in places], len(scores), 1.003)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_segments_take_linear_time():
    n = 200_000
    assert len(toxicity.segments(list(range(0, 20 * n, 20)), [2.0] * n)) == n
    assert len(toxicity.segments(list(range(n)), [2.0] * n)) == 1


def test_scale_of_chance():
    scale = toxicity.chance_scale(np.array([3.0]), np.array([0.01]))
    assert abs(0.01 * math.exp(3 * scale) + 0.99 * math.exp(-scale) - 1) < 1e-6


def test_held_out_accuracy(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.01", "sf0.1")
    found = toxicity.op8_toxicity(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(found) > 500
    assert np.mean([row.predicted == row.toxic for row in found]) > 0.97
    assert np.mean([row.predicted for row in found if row.toxic]) > 0.85
    assert np.mean([row.predicted for row in found if not row.toxic]) < 0.02


def test_toxicity_of_odd_rows(spark, docs_of):
    toxic = [(100 + i, prose(i, 30) + " vile nasty grubby folk " + prose(i + 500, 30)) for i in range(60)]
    fine = [(300 + i, prose(i + 1000, 60)) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, "x") for i, _ in toxic] + [(i, 0, "x") for i, _ in fine] + [(None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, text string")
    docs = docs_of([*ODD, *toxic, *fine, (999, "VILE, nasty!"), (998, None)])
    rows = toxicity.scored(docs, labels).select("row.doc_id", "score", "passages").collect()
    assert len(rows) == len(ODD) + 262
    score = {row.doc_id: row.score for row in rows}
    assert all(0 <= x <= 1 for x in score.values())
    assert np.mean([score[i] >= 0.5 for i, _ in toxic]) > 0.95 and np.mean([score[i] >= 0.5 for i, _ in fine]) < 0.03
    assert score[998] == score[1] == score[2] == min(score.values())
    (passage,) = next(row.passages for row in rows if row.doc_id == 100)
    words = toxic[0][1].split()
    assert {"vile", "nasty"} <= set(words[passage.start : passage.end])
    left = toxicity.clean(docs, labels)
    assert left.columns == docs.columns and 300 <= left.count() + 100 and {4, 7, 8} <= {row.doc_id for row in left.collect()}


def test_nothing_to_learn_from(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {row.score for row in toxicity.scored(docs_of(ODD), none).collect()} == {0.0}
    assert toxicity.scored(docs_of([]), none).collect() == []


# --- URL filters

URLS = [
    None, "", "no scheme", "http://", "https://WWW.Example.COM/en/1?x#y", "http://a.example.com/en/2", "http://example.com/en", "http://xcom/",
    "ftp://x.net/es/a", "http://net/fr/", "http://evil.net/FR/", "http://b.com", "http://b.com?u=http://net/es/", "http://a.org/en/1#/x", "://com/", "http://ex\nample.com/p\nq",
]


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host) :]).group()


def brute_rule(url):
    host, path = split_url(url)
    fit = [r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fit, key=lambda r: len(r[0]) + len(r[1])) if fit else None


def test_given_rules(spark):
    rows = [(i, url, "x") for i, url in enumerate(URLS)] + [(0, URLS[5], "x"), (None, URLS[4], "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = urls.judge(table).collect()
    want = [(i, *split_url(u), *((r[0] + r[1], r[2]) if (r := brute_rule(u)) else (None, "allow"))) for i, u, _ in rows]
    assert sorted([tuple(row)[:5] for row in got], key=str) == sorted(want, key=str)


def test_mined_rules_judge_the_rest(spark):
    pages = [f"http://spam{i % 3}.example.com/en/{i}" for i in range(90)] + [f"http://good{i % 3}.example.com/de/{i}" for i in range(90)]
    pages += [f"http://good{i % 3}.example.net/xx/{i}" for i in range(30)]
    rest = ["http://spam1.example.org/en/7", "http://good1.example.org/de/7", "http://new.example.org/en/7"]
    table = spark.createDataFrame(list(enumerate(pages + rest)), "page_id long, url string")
    verdict = {row.page_id: (row.rule, row.verdict) for row in urls.judge(table).collect()}
    # What a part of the path says holds on sites that no rule has seen as well.
    assert [verdict[len(pages) + i] for i in range(3)] == [(None, "block"), (None, "allow"), (None, "block")]


def test_copies_of_a_url_count_once(spark):
    # One URL with most of the rows would make a rule of its part; counted once it has too few.
    pages = ["http://a.example.com/xx/only"] * 200 + [f"http://a.example.com/en/{i}" for i in range(20)]
    table = spark.createDataFrame(list(enumerate([*pages, "http://a.example.org/only", "http://a.example.org/en/3"])), "page_id long, url string")
    got = {row.page_id: (row.verdict, row.mined_confidence) for row in urls.judge(table).collect()}
    assert got[220] == ("allow", None) and got[221] == ("block", 1.0)


def test_mined_rules_against_counting(spark):
    draw = random.Random(2)
    rows = [(sorted({f"top={draw.choice('ab')}", f"site={draw.choice('cde')}", f"part={draw.choice('fg')}"}), draw.choice(["block", "block", "allow"])) for _ in range(400)]
    got = urls.mined(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.01, 0.7).collect()
    for row in got:
        own = [verdict for tokens, verdict in rows if set(row.antecedent) <= set(tokens)]
        assert abs(row.confidence - own.count(row.verdict) / len(own)) < 1e-9 and row.confidence >= 0.7
    every = {}
    for size in (1, 2, 3):
        for chosen in itertools.combinations(sorted({t for tokens, _ in rows for t in tokens}), size):
            own = [verdict for tokens, verdict in rows if set(chosen) <= set(tokens)]
            for verdict in ("allow", "block"):
                if any(t.startswith("part=") for t in chosen) and own.count(verdict) >= 0.01 * len(rows) and own.count(verdict) >= 0.7 * len(own):
                    every[chosen, verdict] = own.count(verdict) / len(own)
    shorter = lambda a, x: any(set(b) < set(a[0]) and v == a[1] and c >= x for (b, v), c in every.items())
    assert {(tuple(row.antecedent), row.verdict) for row in got} == {a for a, x in every.items() if not shorter(a, x)}


def test_mined_rules_decide_most_pages_without_a_given_rule(spark, sf_dir):
    rest = [row for row in urls.op9_urls(spark, sf_dir).collect() if row.rule is None]
    by_rule = [row for row in rest if row.mined_confidence is not None]
    assert len(by_rule) > 0.5 * len(rest) > 50
    assert all(row.mined_confidence >= urls.MIN_CONFIDENCE for row in by_rule)


def test_urls_query_and_empty_table(spark, small_dir):
    pages = {row.page_id: row.url for row in spark.read.parquet(f"{small_dir}/pages.parquet").collect()}
    for row in urls.op9_urls(spark, small_dir).collect():
        rule = brute_rule(pages[row.page_id])
        assert (row.host, row.path) == split_url(pages[row.page_id])
        assert row.rule == (rule[0] + rule[1] if rule else None) and (rule is None or row.verdict == rule[2])
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []


# --- WARC


class Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        self.out += ["\n"] * (tag in warc.BLOCKS)

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")
        self.out += ["\n"] * (tag in warc.BLOCKS)

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_text_equals_that_of_a_parser(spark, small_dir):
    for row in spark.read.parquet(f"{small_dir}/pages.parquet").collect():
        parser = Text()
        parser.feed(row.html)
        parser.close()
        lines = [" ".join(line.split()) for line in "".join(parser.out).split("\n")]
        assert warc.readable(row.html)[0] == "\n".join(line for line in lines if line)


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("a &lt; b &amp;amp; &#228;", "a < b &amp; ä"),
        ("<p title='a>b'>x</p><!-- <p>no --> y", "x\ny"),
        ("<script>if (a < b) '</p>'</SCRIPT >z<style>q", "z"),
        ("1 < 2 <3 </ x>y <", "1 < 2 <3 y <"),
        ("<a href=\"/x?a=1&amp;b\">l</a><p title=\"open>still <b>text", "l\nstill text"),
        ("cut <div class", "cut"),
        ("<" * 20_000 + "<p '" * 20_000, "<" * 20_000),
    ],
)
def test_readable(page, text):
    assert warc.readable(page)[0] == text


def parse_warc(data: bytes):
    out = []
    while data:
        head, _, data = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        assert lines[0] == "WARC/1.1" and data[size : size + 4] == b"\r\n\r\n"
        out.append((fields, data[:size]))
        data = data[size + 4 :]
    return out


def test_warc_files_round_trip(spark, tmp_path):
    pages = [(1, "http://a/ä", "<title>T &amp; U</title><p>x\r\n\r\ny</p><a href='/l'>l</a>", "x"), (2, None, None, "x"), (2, None, None, "x"), (None, "u", "\U0001f600", "x"), (3, "u\r\nX: y", "", "x")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, block string")
    made = warc.derive(warc.responses(table))
    rows = made.collect()
    assert len(rows) == 10
    response = {row.record_id: row for row in warc.responses(table).collect()}
    for row in rows:
        source = response[row.refers_to]
        assert (row.page_id, row.target_uri, row.source_headers) == (source.page_id, source.target_uri, source.http_headers)
        assert row.content_length == len(row.block.encode())
        for text, digest in ((row.block, row.block_digest), (source.payload, row.source_payload_digest)):
            assert digest == "sha1:" + base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
    assert len({row.record_id for row in rows}) == 8
    assert "title: T & U\r\n" in rows[0].block and "outlink: /l\r\n" in rows[0].block and rows[1].block == "T & U\nx\ny\nl"
    warc.write_warc(made, str(tmp_path / "out"))
    found = [record for part in sorted((tmp_path / "out").glob("part-*")) for record in parse_warc(part.read_bytes())]
    want = sorted((row.record_type, row.record_id, row.refers_to, row.block_digest, row.block) for row in rows)
    got = sorted((f["WARC-Type"], f["WARC-Record-ID"], f["WARC-Refers-To"], f["WARC-Block-Digest"], block.decode()) for f, block in found)
    assert got == want
    assert warc.derive(warc.responses(table.limit(0))).collect() == []


# --- pipeline


def test_pipeline_against_its_operators(spark, small_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    left = {}
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, small_dir), name)
        left[name] = docs.collect()
    scores = {row.doc_id: row.predicted for row in toxicity.op8_toxicity(spark, small_dir).collect()}
    assert {row.doc_id for row in left["toxicity"]} == {i for i, toxic in scores.items() if not toxic}
    ids = [{row.doc_id for row in left[name]} for name, _ in pipeline.STAGES[:4]]
    assert ids[0] >= ids[1] >= ids[2] == ids[3] and len(ids[2]) > 0.7 * len(scores)
    texts = [row.text for row in left["near_dedup"]]
    assert len(set(texts)) == len(texts)
    assert not any(base_spans(row.text) for row in left["pii"])
    by_doc = {row.doc_id: row.text for row in left["pii"]}
    words = packing.WordIds(packing.VOCABULARY)
    for row in left["packing"]:
        tokens = words.tokenizer.encode(by_doc[row.doc_id] or "", add_special_tokens=False).ids + [packing.END_ID]
        assert row.start + row.length <= len(tokens)
    assert {row.doc_id for row in left["packing"]} == ids[3]
    again = pipeline.run(spark, small_dir)
    assert sorted(again.select("doc_id", "piece", "ids_crc32").collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in left["packing"])


def test_pipeline_of_odd_tables(spark, tmp_path, docs_of):
    """Null and empty texts, rows without an id, repeated rows, clashing names, and no rows at all, through all stages."""
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [*ODD, (4, "one repeated row of ten words or so in it"), (None, None), (30, "mail jane@example.org " + prose(5, 30))]
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(0, 40)], "doc_id long, toxic int, score string")
    benchmark = spark.createDataFrame([(1, " ".join(prose(2, 60_000).split()[500:520]), "x"), (2, None, "x"), (None, "a b", "x")], "item_id long, text string, spans string")
    for name, table in (("full", docs_of(rows)), ("none", docs_of([]))):
        for part, frame in (("documents", table), ("labels", labels if name == "full" else labels.limit(0)), ("benchmark", benchmark if name == "full" else benchmark.limit(0))):
            frame.write.parquet(f"{tmp_path}/{name}/{part}.parquet")
    docs, left = spark.read.parquet(f"{tmp_path}/full/documents.parquet"), {}
    columns = docs.columns
    for stage, run in pipeline.STAGES:
        docs = materialize(run(spark, docs, f"{tmp_path}/full"), stage)
        left[stage] = docs.collect()
        assert stage == "packing" or docs.columns == columns
    near = [(row.doc_id, row.text) for row in left["near_dedup"]]
    assert len(near) == len(set(near)) and (6, prose(1, 120)) not in near
    assert set(near) - {(6, prose(1, 120))} == {(row.doc_id, row.text) for row in left["toxicity"]} - {(6, prose(1, 120))}
    assert {(row.doc_id, row.text) for row in left["decontamination"]} == set(near) - {(7, prose(2, 60_000))}
    assert {row.doc_id: row.text for row in left["pii"]}[30] == "mail [email] " + prose(5, 30)
    assert Counter(row.doc_id for row in left["packing"] if row.piece == 0) == Counter(row.doc_id for row in left["pii"])
    assert pipeline.run(spark, f"{tmp_path}/none").collect() == []
