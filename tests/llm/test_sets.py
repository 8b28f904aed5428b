"""Mixing, top-k, near-duplicates, URL rules, toxicity and personal data against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from harborline.llm import mixing, near_dup, pii, topk, toxicity, url_filter
from tests.llm.rows import frame, make, sorted_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- Mixing ----------------------------------------------------------------------------------------


def test_targets_are_filled_and_met(spark):
    rows = make()
    got = mixing.mix(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += size(text)
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    clamped = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in clamped)
        share = {s: weight[s] * rest / sum(weight[o] for o in names if o not in clamped) for s in names if s not in clamped}
        over = {s for s in share if share[s] > 3 * sizes[s]}
        if not over:
            break
        clamped |= over
    target = {s: share.get(s, 3 * sizes[s]) for s in names}
    taken = Counter()
    for r in got:
        assert r.size == size(r.row.text) and r.source_size == sizes[r.row.source]
        assert math.isclose(r.target, target[r.row.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.row.source] += r.taken
    assert clamped and all(abs(taken[s] - target[s]) < 1 for s in names)
    again = mixing.mix(frame(spark, rows).repartition(5)).collect()
    assert sorted_rows((r.row.doc_id, r.taken, r.copies) for r in got) == sorted_rows((r.row.doc_id, r.taken, r.copies) for r in again)


def test_mixing_nothing(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    empty = mixing.mix(frame(spark, [(1, "", "en", "a"), (2, None, None, None)])).collect()
    assert [(r.target, r.taken) for r in empty] == [(0.0, 0)] * 2


def test_no_epochs_to_spare_takes_everything_once(spark):
    got = mixing.mix(frame(spark), max_epochs=1).collect()
    assert all(r.taken == r.size for r in got)


# ---- Top-k -----------------------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)], 0) for i in range(300)]
    rows += [(i, [0.5, -0.25] * 4, 1) for i in range(300, 330)]  # ties
    bad = [(400, None, 0), (450, [1.0, None], 0), (500, [float("nan")] * 8, 0), (501, [float("inf")] * 8, 0)]
    odd = [(550, [], 0), (551, [2.0], 0), (None, [1.0] * 8, 0)]
    df = spark.createDataFrame([*rows, *bad, *odd, *rows[:3]], "vec_id long, embedding array<float>, label int")
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v, _ in ((r.vec_id, r.embedding, 0) for r in df.distinct().collect())
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, a in good:
        if q is not None and q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), c is None, c or 0) for c, b in good if c != q)[:5]
            want += [(q, n + 1, None if none else c, -s) for n, (s, none, c) in enumerate(best)]
    for blocks in ((16384, 2048), (40, 3)):
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, candidate_block=blocks[0], query_block=blocks[1])
        assert sorted_rows(got.collect()) == sorted_rows(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_top_k_of_huge_components(spark):
    df = spark.createDataFrame([(0, [1e7, 1.0]), (1, [1e6, 2.0]), (2, [1e6, 2.5]), (3, [1e30, 1.0])], "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") == 0).collect()
    big = 256 * 10**7 * 256 * 10**6
    assert [(r.vec_id, r.score) for r in got] == [(3, 2**63 - 1), (2, big + 256 * 640), (1, big + 256 * 512)]


# ---- Near-duplicates -------------------------------------------------------------------------------


def plain_simhash(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i: i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_groups_equal_brute_force(spark):
    rows = make()
    prints = [plain_simhash(t) for _, t, *_ in rows]
    kinds = sorted(set(prints))
    linked = [(a, b) for a in kinds for b in kinds if a < b and (a ^ b).bit_count() <= 2]
    root = plain_components(kinds, linked)
    ids = {}
    for (doc_id, *_), p in zip(rows, prints):
        if doc_id is not None:
            ids[root[p]] = min(doc_id, ids.get(root[p], doc_id))
    got = near_dup.groups(frame(spark, rows)).select("doc_id", near_dup.unsigned_hex(F.col("fp")), "component_id")
    assert sorted_rows(got.collect()) == sorted_rows((r[0], f"{p:016x}", ids.get(root[p])) for r, p in zip(rows, prints))
    kept = near_dup.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns and kept.count() == len(set(root.values()))
    assert near_dup.groups(frame(spark, [])).collect() == []


def test_links_find_every_near_pair(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for p in base:
        for flips in (1, 2, 2, 3):
            q = p
            for bit in rng.sample(range(64), flips):
                q ^= 1 << bit
            prints.add(q)
    dense = rng.getrandbits(64)
    prints |= {dense ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(12, 24)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    got = {tuple(r) for r in near_dup.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2}
    assert got == want


def test_components_of_a_chain_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1040)] + [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)]
    got = dict(tuple(r) for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = plain_components({n for e in edges for n in e}, edges)
    assert got == want


# ---- URL rules -------------------------------------------------------------------------------------

RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
    ("block", "net", "/fr/"), ("allow", "a.net", ""), ("block", None, "/x"), ("allow", "b.net", None), ("block", "co", "/"),
]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + (p or "")), len(h), v, h + (p or "")) for v, h, p in RULES
        if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p or "")
    ]
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_url_rules_equal_brute_force(spark, partitions):
    rng = random.Random(6)
    hosts = ["example.com", "WWW.example.com", "x.www.example.com", "shop.com", "a.net", "q.a.net", "b.net", "net", "com", "community", "co", "x.co", "", "org"]
    tails = ["", "/", "/en/1", "/en", "/es/2?x=/fr/", "/fr/#a", "?q", "#f", "/EN/1", "//en/"]
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts)}{rng.choice(tails)}" for _ in range(300)]
    urls += [None, "", "no scheme", "http://", "://example.com/en/"] + ["http://hot.example.com/en/9"] * 150
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = url_filter.judge(pages, rules).collect()
        none = url_filter.judge(pages, rules.limit(0)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert sorted_rows(got) == sorted_rows((i, *plain_verdict(u)) for i, u in enumerate(urls))
    assert {r.verdict for r in none} == {"allow"} and len(none) == len(urls)
    assert url_filter.judge(pages.limit(0), rules).collect() == []


# ---- Toxicity --------------------------------------------------------------------------------------


def toxic_rows(n=400):
    rng = random.Random(8)
    plain = ["harbor", "crane", "vessel", "berth", "cargo", "pilot", "tug", "quay"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vileword", "nastyword"]))
        rows.append((i, " ".join(words), "en", "s1"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_generalises_to_held_out_rows(spark):
    rows, labels = toxic_rows()
    marked = spark.createDataFrame([*labels, (3, 0, None), (None, 1, 1), *labels[:5]], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows + make()[60:])
    got = toxicity.classify(docs, marked).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {i: t for i, _, t in labels}
    out = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id < 100]
    assert len(out) > 10 and all(r.predicted == truth[r.doc_id] for r in out)
    kept = toxicity.keep_harmless(docs, marked)
    assert kept.columns == docs.columns and kept.filter("text like '%vileword%'").count() == 0
    # labels of held-out rows change nothing
    flipped = marked.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted_rows(toxicity.classify(docs, flipped).collect()) == sorted_rows(got)


def plain_bins(text):
    """Bins of the distinct n-grams, by loops over characters."""
    out, points = set(), [ord(c) for c in (text or "").lower()]
    for n in toxicity.ORDERS:
        for at in range(len(points) - n + 1):
            gram = 0
            for p in points[at: at + n]:
                gram = (gram * 0x9E3779B97F4A7C15 + p + 1) % (1 << 64)
            out.add(((gram ^ (gram >> 31)) * 0xD6E8FEB86659FD93) % (1 << 64) >> (65 - toxicity.BINS.bit_length()))
    return sorted(out)


def test_toxicity_counts_ratios_scores_and_fit_equal_brute_force(spark):
    rows, labels = toxic_rows(120)
    rows += [(rows[0][0], rows[0][1], "en", "s1")] * 2 + [(500, "", "en", "s1"), (501, None, "en", "s1"), (502, "Ärger 😀 naïve", "en", "s1")]
    labels += [(500, 1, 0), (501, 1, 0), (900, 1, 1)]  # the last has no document
    docs, marked = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ratio, weights, intercept = toxicity.fit(docs, marked)
    truth = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 5}
    counts, seen = np.zeros((2, toxicity.BINS)), [0, 0]
    for i, text, *_ in rows:
        if i in truth:
            counts[truth[i], plain_bins(text)] += 1
            seen[truth[i]] += 1
    share = [(counts[c] + 1) / (seen[c] + 2) for c in (0, 1)]
    assert np.allclose(ratio, np.log(share[1]) - np.log(share[0]), atol=1e-5)

    def vector(text):
        x = np.zeros(toxicity.BINS)
        bins = plain_bins(text)
        x[bins] = ratio[bins]
        return x / (np.linalg.norm(x) or 1)

    got = {r.doc_id: r.score for r in toxicity.classify(docs, marked).collect()}
    for i, text, *_ in rows:
        assert abs(got[i] - 1 / (1 + np.exp(-(vector(text) @ weights + intercept)))) < 1e-5
    # the weights are where the penalised loss of the sample, one row an id, is flat
    ids = {i: text for i, text, *_ in rows if i in truth}
    label = np.array([truth[i] for i in ids])
    x = np.array([vector(t) for t in ids.values()])
    weight = np.where(label == 1, seen[1] / label.sum(), seen[0] / (1 - label).sum())
    error = weight / weight.sum() * (1 / (1 + np.exp(-(x @ weights + intercept))) - label)
    assert abs(error.sum()) < 2e-3 and np.abs(x.T @ error + toxicity._PENALTY * weights).max() < 2e-3


def test_toxicity_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.classify(frame(spark), none).collect()} == {0.0}
    assert toxicity.classify(frame(spark, []), none).collect() == []


# ---- Personal data ---------------------------------------------------------------------------------


def plain_base(text):
    text = text or ""
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) < 256 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m)) <= 15]
    order = {k: i for i, k in enumerate(pii.KINDS)}
    return [(s, order[k], e) for s, _, e, k in sorted((m.start(), order[k], m.end(), k) for k, m in found)]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(11)
    pieces = ["a", "b.", "@", "c@d.e", "1", "23.", "255", ".", "-", " ", "+", "(", ")", "4111111111111111", "%", "é", "256.1.2.3", "+1 (212) 555-0100"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain_base(text), text
    assert len(pii.base_spans("x" * 300_000 + "@" + "1" * 300_000)) == 0


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rng = random.Random(12)
    rows = [(1000 + i, f"please ring office: +1 (212) 555-{1000 + i} today, the {i} ships of 5{i}", "en", "s1") for i in range(30)]
    rows += [(50, "kindly ring office: 212 555 0199 now", "en", "s1"), (51, "it of the 2125550198 and of 2125550197 alone", "en", "s1")]
    rows += [(2000 + i, f"{rng.choice(['the', 'of'])} +1 (212) 555-{2000 + i} the of the of", "en", "s2") for i in range(20)]
    rows += make()[60:]
    got = pii.report(pii.find(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[50].spans == "phone:20:32" and by[50].n_phone == 0
    assert by[51].spans == "" and by[100].spans == "" and by[106].n_email == by[106].n_ip == by[106].n_card == by[106].n_phone == 1
    for doc_id, text, *_ in rows:
        want = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in plain_base(text))
        assert set(want.split(",")) <= set(by[doc_id].spans.split(",")) or not want
    clean = {r.doc_id: r for r in pii.redact(frame(spark, rows)).collect()}
    assert clean[50].text == "kindly ring office: [PHONE] now" and clean[50].n_chars == len(clean[50].text)
    assert "@" not in clean[106].text and clean[51].text == rows[31][1] and clean[100].text is None
    assert pii.report(pii.find(frame(spark, []))).collect() == [] and pii.redact(frame(spark, [])).collect() == []
