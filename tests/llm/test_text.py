"""Substring removal, URL filters, toxicity and token counts against brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from martlet.llm import substrings, token_counts, toxicity, urls
from martlet.llm.queries import REGISTRY, URL_RULES, vocabulary
from martlet.llm.tokens import Encoder

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def load(spark, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*columns).collect()]


# substring removal

def slow_removal(rows, size=50):
    least = {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in split:
        if d is not None:
            for i in range(len(w) - size + 1):
                k = tuple(w[i:i + size])
                least[k] = min(d, least.get(k, d))
    out = []
    for d, w in split:
        keep = [True] * len(w)
        if d is not None:
            for i in range(len(w) - size + 1):
                if least[tuple(w[i:i + size])] < d:
                    keep[i:i + size] = [False] * size
        left = " ".join(x for x, k in zip(w, keep) if k)
        out.append((d, len(w), len(w) - sum(keep), hashlib.sha256(left.encode()).hexdigest()))
    return out


def core(rows):
    return [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows]


def test_removal_from_documents(spark):
    got = REGISTRY["op7_substrings"](spark, SF).collect()
    want = slow_removal(load(spark, "documents", "doc_id", "text"))
    assert key(core(got)) == key(want) and sum(r[2] for r in want) > 1000


def test_removal_from_odd_rows(spark):
    rnd = random.Random(8)
    pool = [f"w{i}" for i in range(400)]
    base = [rnd.choice(pool) for _ in range(700)]
    spans = [base[a:b] for a, b in ((0, 50), (10, 59), (100, 330), (300, 420), (0, 700), (351, 402), (690, 700))]
    rows = [(50, " ".join(base)), (50, " ".join(base)), (50, "other text " + " ".join(spans[2]))]
    for i in range(60):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            parts += rnd.choice(spans) + [f"own{rnd.randint(0, 9)}" for _ in range(rnd.randint(0, 3))]
        rows.append((rnd.randint(0, 100), "\n".join(parts)))
    rows += [(1, None), (2, ""), (3, " \t"), (4, "one"), (None, " ".join(base)), (-7, "a " * 300), (9, "a " * 120),
             (200, "a b " * 20_000), (201, "b a " * 20_000), (5, "\x1c".join(base[:60])), (6, "\x1c".join(base[:60]))]
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, kept string")
    got = substrings.without_repeats(docs).collect()
    assert key(core(got)) == key(slow_removal(rows))
    for r in got:
        assert (r.kept is None) == (r.n_removed == 0)
    assert substrings.without_repeats(docs.limit(0)).count() == 0
    only = spark.createDataFrame([(1, "x " * 200)], "doc_id long, text string")
    assert [r.n_removed for r in substrings.without_repeats(only).collect()] == [0]


def test_kept_kmers_and_rolled_hashes():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 50, 900).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for size in (1, 2, 3, 26, 50):
        r = substrings.rolled(h, size, 0)
        seen = {}
        for i in range(len(h) - size + 1):
            assert seen.setdefault(tuple(h[i:i + size].tolist()), r[i]) == r[i]
        assert len(set(r.tolist())) == len(seen)
    bounds = np.array([0, 0, 30, 400, 449, 499, 900])
    at, one, _ = substrings.kept_kmers(h, bounds, 26, 25)
    at = set(at.tolist())
    hashes = substrings.rolled(h, 26, 0)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        mine = {p for p in at if a <= p < b}
        if b - a < 50:
            assert not mine
            continue
        want = {a, b - 26}
        for i in range(a, b - 49):
            w = hashes[i:i + 25]
            want |= {i + k for k in range(25) if w[k] == w.min()}
        assert mine == want


def test_kept_nodes_have_every_window_once():
    rng = np.random.default_rng(4)
    h = np.concatenate([rng.integers(0, 9, 400), np.full(300, 7), rng.integers(0, 9000, 300), np.arange(400) % 3])
    h = h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bounds = np.array([0, 0, 30, 550, 620, 669, 1000, 1400])
    at, one, two, times, since, many = substrings.kept_nodes(h, bounds, 26, 25)
    kept = substrings.kept_kmers(h, bounds, 26, 25)
    assert [p + i for p, n in zip(at, times) for i in range(n)] == kept[0].tolist() and len(at) < len(kept[0]) - 150
    hashes, seen = substrings.rolled(h, 26, 0), []
    for x, a, n in zip(one.tolist(), since.tolist(), many.tolist()):
        seen += range(a, a + n)
        assert all(hashes[i:i + 25].min() == x for i in range(a, a + n))
    want = [i for a, b in zip(bounds[:-1], bounds[1:]) for i in range(a, b - 49)]
    assert sorted(seen) == want


def compared(spark, monkeypatch, rows):
    """Rows of the tables that a removal stores; its result is right."""
    counts, stored = {}, substrings.stored

    def counted(df, name):
        out = stored(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(substrings, "stored", counted)
    got = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    monkeypatch.setattr(substrings, "stored", stored)
    assert key(core(got)) == key(slow_removal(rows))
    return counts


def test_only_open_windows_are_compared(spark, monkeypatch):
    base = " ".join(f"w{i}" for i in range(400))
    counts = compared(spark, monkeypatch, [(1, base), (2, base), (3, base), (4, "a " * 300), (5, "a " * 200)])
    # windows of copies are known, those of one word said over and over are one
    assert counts["windows"] == 2 and counts["runs"] == 5


def test_common_lines_without_a_window_meet_in_no_join(spark, monkeypatch):
    line = " ".join(f"w{i}" for i in range(45))
    rows = [(d, " ".join(f"{line} {' '.join(f'own{d}x{n}y{i}' for i in range(30))}" for n in range(4))) for d in range(12)]
    counts = compared(spark, monkeypatch, rows)
    assert counts["nodes"] > 40 and counts["runs"] == 0


def test_sources_of_one_id_are_told_apart(spark, monkeypatch):
    a, b = ([f"{c}{i}" for i in range(90)] for c in "ab")
    x, y = ([f"{c}{i}" for i in range(40)] for c in "xy")
    rows = [(1, " ".join([*a, *x])), (1, " ".join([*y, *b])), (2, " ".join([*a, *b])), (3, " ".join([*a, *b, *x]))]
    compared(spark, monkeypatch, rows)


# URL filters

def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def slow_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host):])[0]


def slow_rule(host, path, rules):
    fit = []
    for verdict, rule in rules:
        domain, _, tail = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + tail):
            fit.append((len(rule), rule, verdict))
    return max(fit)[1:] if fit else (None, None)


def slow_pages(pages, rules, margin=2.0, damping=0.85, rounds=16):
    weight, seeds, own = Counter(), defaultdict(Counter), Counter()
    judged = []
    for page_id, url, html in pages:
        host, path = slow_parts(url)
        rule, verdict = slow_rule(host, path, rules)
        judged.append((page_id, host, path, rule, verdict))
        if verdict:
            seeds["trust" if verdict == "allow" else "distrust"][host] += 1
        if host:
            own[host] += 1
            for to in re.findall(r"(?i)href\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)", html or ""):
                if lower(to) != host:
                    weight[host, lower(to)] += 1
    for h in own:
        up = h.partition(".")[2]
        if up in own:
            weight[h, up] += own[h]
            weight[up, h] += own[h]
    rank = {}
    for kind in ("trust", "distrust"):
        arcs = {(a, b) if kind == "trust" else (b, a): w for (a, b), w in weight.items()}
        out = Counter()
        for (a, _), w in arcs.items():
            out[a] += w
        total = sum(seeds[kind].values())
        start = {h: m / total for h, m in seeds[kind].items()}
        r = dict(start)
        for _ in range(rounds):
            new = Counter()
            for (a, b), w in arcs.items():
                new[b] += damping * r.get(a, 0) * w / out[a]
            back = 1 - sum(new.values())
            for h, m in start.items():
                new[h] += back * m
            r = new
        rank[kind] = r
    out = []
    for page_id, host, path, rule, verdict in judged:
        t, d = (round(rank[k].get(host, 0), 9) for k in ("trust", "distrust"))
        out.append((page_id, host, path, rule, verdict or ("block" if d > margin * t else "allow"), t, d))
    return out


def same_pages(got, want):
    got, want = key(got), key(want)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], abs=1e-6)


def test_urls_of_pages(spark):
    got = REGISTRY["op8_urls"](spark, SF).collect()
    same_pages(got, slow_pages(load(spark, "pages", "page_id", "url", "html"), URL_RULES))


def test_urls_of_odd_rows(spark):
    link = '<a HREF="https://{0}/x">a</a> <a href=//{0}?q>b</a>'.format
    pages = [(1, None, None), (2, "", ""), (3, "no scheme", "x"), (4, "http://", None), (5, "HTTP://A.Org", None),
             (6, "http://a.org?x://y/", None), (7, "x://sub.Example.ORG/es/p?q#r", link("bad.net")),
             (8, "http://example.org/en/12/#a", ""), (9, "http://example.org/en/2", ""), (10, "http://xorg/", ""),
             (11, "http://a.com/fr/", link("b.net") + link("É.net")), (12, "http://b.com/de/", link("b.net")),
             (13, "http://b.net/p", link("b.com")), (14, "http://bad.net/", link("sub.example.org")),
             (15, "http://É.net/", ""), (15, "http://É.net/", ""), (16, "http://c.a.com/en/", ""),
             (None, "http://a.com:80/fr/x", None), (17, "http://u@com/de/", None), (18, "http://shady.net/", link("b.com") * 5)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")
    rules = URL_RULES + [("allow", "b.net/p"), ("block", "b.net/p")]
    table = urls.rule_table(spark, rules)
    same_pages(urls.filtered(df, table).collect(), slow_pages(pages, rules))
    assert urls.filtered(df.limit(0), table).count() == 0
    assert {r.verdict for r in urls.filtered(df, table.limit(0)).collect()} == {"allow"}


def test_small_ranks_are_judged(spark):
    link = '<a href="https://{0}/x">a</a> '.format
    pages = [(0, "https://bad.net/", "")]
    for i, to in enumerate(("bad.net", "h0.net", "h1.net")):
        pages += [(2 * i + 1, f"https://h{i}.net/", link(to)), (2 * i + 2, f"https://n{i}.net/", link(to) * 2000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.filtered(df, urls.rule_table(spark, [("block", "bad.net/")])).collect()}
    assert got[5].distrust == 0.0  # as shown: under half of the last decimal
    assert {r.verdict for r in got.values()} == {"block"}


# toxicity

def test_toxicity_on_held_out_documents(spark):
    got = {r.doc_id: r for r in REGISTRY["op9_toxicity"](spark, SF).collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    held = [(y, got[d].predicted) for d, y in load(spark, "labels", "doc_id", "toxic") if got[d].held_out]
    assert sum(y == p for y, p in held) >= 0.93 * len(held)


def test_toxicity_never_reads_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    a, b = ({r.doc_id: r.score for r in toxicity.scored(docs, x).collect()} for x in (labels, turned))
    assert a == b


def slow_clause(words, weights, factors):
    """A clause's score without any machine."""
    total = 0.0
    for i, w in enumerate(words):
        own = max((weights[x] for x in toxicity.stems(w) if x in weights), default=0)
        insult = own > 0

        def others(words, kind):
            return any(v in kind and not any(x in weights for x in toxicity.stems(v)) and v not in toxicity.THREAT for v in words)
        if not insult and w not in toxicity.THREAT:
            continue
        targeted = others(words[:i] + words[i + 1:], toxicity.TARGET)
        f = factors["targeted"] if targeted else 1.0 if insult else factors["untargeted"]
        f *= factors["negated"] if others(words[max(0, i - toxicity.REACH):i], toxicity.NEGATION) else 1
        f *= factors["reported"] if others(words[:i], toxicity.REPORTING) else 1
        total += f * (own if insult else toxicity.THREAT_WEIGHT)
    return total


def test_grammar_equals_brute_force_on_random_clauses():
    weights, factors = {"fool*": 3.0, "pest": 2.0}, {"targeted": 1.7, "negated": 0.1, "reported": 0.3, "untargeted": 0.2}
    g, rng = toxicity.Grammar(weights, factors), random.Random(8)
    words = ["fools", "pest", "kill", "you", "not", "said", "a", "b", "c", "pests", "foolish"]
    for _ in range(3000):
        clause = rng.choices(words, k=rng.randrange(12))
        assert g.clause(clause) == pytest.approx(slow_clause(clause, weights, factors))


def test_composition_equals_one_machine_after_the_other():
    first = toxicity.within_reach("negation", "negated", 2, ())
    second = toxicity.behind("report", "reported", ("negated",))
    third = toxicity.weighing(toxicity.PRIOR, ("negated", "reported"))
    machine, rng = toxicity.composed(toxicity.composed(first, second), third), random.Random(1)
    for _ in range(500):
        read = rng.choices(toxicity.alphabet(()), k=9)
        step = third.run([x for x, _ in second.run([x for x, _ in first.run(read)])])
        assert machine.run(read) == step
    # one machine of reachable states, not the three in turn
    assert len({s for s, _ in machine.arcs}) == 3 * 2


def test_clauses_by_how_a_word_is_said():
    g = toxicity.Grammar({"fool*": 3.0, "pest": 2.0})
    f = toxicity.PRIOR
    assert g.evidence("Fools everywhere. A pest") == 5
    assert g.evidence("you are a foolish one") == g.evidence("one fool, no: fool you") - 3 == 3 * f["targeted"]
    assert g.evidence("that is not a fool") == pytest.approx(3 * f["negated"])
    assert g.evidence("not at all here or there or anywhere, fool") == 3
    assert g.evidence("they said he is a pest") == pytest.approx(2 * f["reported"] * f["targeted"])
    assert g.evidence("I will hurt you") > 10 * g.evidence("I will never hurt you") > 0
    assert g.evidence("hurt feelings") < 1
    assert g.evidence("pestilence tomfool") == 0  # a whole word isn't a stem, a stem begins a word
    assert not g.evidence("") and not g.evidence(None) and not g.contexts(None).any()


SENTENCES = {"an idiot wrote this": 1, "you are an idiot": 1, "you are a stupid worthless idiot and a moron": 1,
             "I will kill you": 1, "that is not an idiot": 0, "nobody here is an idiot, not you": 0,
             "he said you are an idiot": 0, "I will never kill you": 0, "the process was not killed": 0}


def test_toxicity_of_sentences(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    added = spark.createDataFrame([(-1 - i, s) for i, s in enumerate(SENTENCES)], "doc_id long, text string")
    rows = toxicity.scored(docs.unionByName(added), labels)
    got = {r.doc_id: r for r in rows.collect()}
    assert {s: got[-1 - i].predicted for i, s in enumerate(SENTENCES)} == SENTENCES
    by = {s: got[-1 - i].score for i, s in enumerate(SENTENCES)}
    assert by["you are an idiot"] > by["an idiot wrote this"] > by["he said you are an idiot"] > by["that is not an idiot"]
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert len(held) > 700 and sum(p != t for p, t in held) < 0.03 * len(held)


def test_factors_stay_in_their_bounds():
    """Labels that say the reverse move a factor to its bound and no further."""
    rng = np.random.default_rng(2)
    place = {x: k for k, x in enumerate(toxicity.CONTEXTS)}
    rows, y = [], []
    for marks, toxic in ((("negated",), 1), (("targeted",), 0), (("reported",), 1), ((), 1)):
        for _ in range(2000):
            r = np.zeros(len(place))
            r[place[toxicity.Symbol(toxicity.INSULT, frozenset(marks))]] = 5 + rng.random()
            rows.append(r)
            y.append(toxic)
    rows += [np.zeros(len(place))] * 2000
    factors, slope, _ = toxicity.fitted(np.array(rows), np.array(y + [0] * 2000, float), hold=0.1)
    assert factors["targeted"] >= 1 and factors["negated"] <= 1 and factors["reported"] <= 1 and slope >= 0
    assert all(lo <= factors[m] <= hi for m, (lo, hi) in toxicity.BOUNDS.items())


def test_toxicity_of_odd_rows(spark):
    rows = [(i, f"plain words number {i} and {'fool' if i % 3 == 0 else 'friend'} here", "x") for i in range(90)]
    odd = [(900, None, "x"), (901, "", "x"), (None, "a fool", None), (902, "fine words " * 50_000 + "fool", "x"), (903, "a fool", "x"),
           (903, "a fool", "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(None, 1), (7, None), (8, 0)],
                                   "doc_id long, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == 96
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == (i % 3 == 0) for i in range(90))
    assert by[902].predicted == by[903].predicted == by[None].predicted == 1
    assert by[900].score == by[901].score < 0.5 and by[None].held_out is False
    for some in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r.score for r in toxicity.scored(docs, some).collect()} == {0.0}
    assert toxicity.scored(docs.limit(0), labels).count() == 0


def test_repeated_labelled_ids(spark):
    rows = [(i, f"plain words number {i} and {'fool' if i % 3 == 0 else 'friend'} here") for i in range(90)]
    rows += [(i, f"plain fool {n % 150} here") for i in (3, 6, 9, 12) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    train = toxicity.sampled(docs, labels, 100).collect()
    assert len(train) == len({(r.doc_id, r.text) for r in train}) == 100
    assert {r.doc_id for r in train} == {i for i in range(90) if zlib.crc32(str(i).encode()) % 5}
    got = toxicity.scored(docs, labels, rows=100).collect()
    assert len(got) == len(rows) and all(r.predicted == (r.doc_id % 3 == 0) for r in got)


def test_rare_stems_stay_beside_many_frequent_ones(spark):
    many = " ".join(f"{i:04}".translate(str.maketrans("0123456789", "abcdefghij")) + "xyz" for i in range(1000))
    rows = [(i, many, 1) for i in range(10)] + [(i, "seldom", 1) for i in range(10, 15)] + [(i, "fine", 0) for i in range(20, 60)]
    train = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert any("seldom".startswith(s.rstrip("*")) for s in toxicity.learned(train))
    with pytest.raises(ValueError, match="stems"):
        toxicity.learned(train, most=2000)


# token counts

def slow_totals(rows, enc):
    def n(text):
        return len(enc.tokenizer.encode(text, add_special_tokens=False).ids)

    seen, out = set(), Counter()
    for doc_id, source, lang, text in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r[:3])):
        text = text or ""
        if text not in seen:
            seen.add(text)
            k = (source, lang, "byte_bpe_50k")
            out[k] += 1
            out[(*k, "n")] += n(" ".join(WORD.findall(text)))
    return [(*k, v, out[(*k, "n")]) for k, v in out.items() if len(k) == 3]


def test_counts_of_documents(spark):
    enc = Encoder(vocabulary())
    got = REGISTRY["op5_token_counts"](spark, "/root/testdata/sf0.001").collect()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "source", "lang", "text").collect()]
    assert key(got) == key(slow_totals(rows, enc))


def test_counts_of_odd_rows(spark):
    rows = [(1, "a", "en", "x  y"), (1, "a", "en", "x  y"), (2, None, "en", "x  y"), (3, "a", None, None), (4, "a", "en", ""),
            (None, "b", "en", "z z"), (5, "b", "en", "z z"), (6, "c", "en", " long " * 20_000)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, source string, lang string, text string, n_tokens int")
    got = token_counts.rolled_up(docs, vocabulary(), "byte_bpe_50k").collect()
    assert key(got) == key(slow_totals(rows, Encoder(vocabulary())))
    assert token_counts.rolled_up(docs.limit(0), vocabulary(), "v").count() == 0


def test_rollups_are_idempotent_and_additive(spark, tmp_dir):
    schema = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"
    store = token_counts.Rollups(spark, f"{tmp_dir}/store")

    def changes(*rows):
        return spark.createDataFrame([(op, s, "en", v, n, o) for op, s, v, n, o in rows], schema)

    first = changes(("insert", "a", "v1", 10, None), ("insert", "a", "v1", 5, None), ("insert", None, "v2", 7, None))
    second = changes(("delete", "a", "v1", None, 5), ("revise", "a", "v1", 12, 10), ("delete", None, "v2", None, 7))
    assert store.totals().count() == 0
    store.commit("b1", first)
    store.commit("b2", second)
    for batch, rows in (("b2", second), ("b1", first), ("b1", first)):
        store.commit(batch, rows)
        assert [tuple(r) for r in store.totals().collect()] == [("a", "en", "v1", 1, 12)]
    with pytest.raises(Exception, match="unknown change"):
        store.commit("b3", changes(("upsert", "a", "v1", 1, None)))
    assert [tuple(r) for r in store.totals().collect()] == [("a", "en", "v1", 1, 12)]
    with pytest.raises(ValueError):
        store.commit("../b", first)
    # a batch of another content under a name that was there replaces it
    store.commit("b1", changes(("insert", "a", "v1", 10, None), ("insert", "a", "v1", 5, None)))
    assert {tuple(r) for r in store.totals().collect()} == {("a", "en", "v1", 1, 12), (None, "en", "v2", -1, -7)}
    # a commit that broke off before its totals were whole is as if it had not begun
    os.makedirs(f"{tmp_dir}/store/totals/v={store._version() + 1}")
    assert store.totals().count() == 2
    store.commit("b4", first)
    assert {tuple(r) for r in store.totals().collect()} == {("a", "en", "v1", 3, 27)}
