"""Contexts that grow over rounds, stand glued to an identifier, or fit several kinds; rounds and added spans by brute force."""

import math
import random
import re
from collections import Counter, defaultdict

from harborline.llm import pii
from tests.llm.rows import frame, make


def spans(spark, rows):
    return {r.doc_id: r.spans for r in pii.report(pii.find(frame(spark, rows))).collect()}


def doc(i, text):
    return i, text, "en", "s1"


def test_trusted_instances_induce_further_patterns(spark):
    rows = [doc(i, f"ring office: +1 (212) 555-{1000 + i} today") for i in range(6)]
    rows += [doc(100 + i, f"ring office: 212 555 {2000 + i} today") for i in range(20)]  # most instances unseen
    rows += [doc(200 + i, f"desk line 212 555 {2000 + i} today") for i in range(6)]  # no seed, only instances of the pattern above
    rows += [doc(300, "desk line 212 555 9999 today"), doc(301, "count was 212 555 9998 today")]
    got = spans(spark, rows)
    assert got[100] == "phone:13:25" and got[119] == "phone:13:25"
    assert got[300] == "phone:10:22" and got[301] == ""


def test_words_after_a_context_speak_against_it(spark):
    rows = [doc(i, f"the office +1 (212) 555-{1000 + i} today") for i in range(6)]
    rows += [doc(100 + i, "the office closes") for i in range(4)] + [doc(200, "the office 212 555 0199 today")]
    assert spans(spark, rows)[200] == ""


def test_contexts_glued_to_the_identifier(spark):
    long = "y" * 300
    for n, before in enumerate(["call tel:", "mail <", 'say "', "is x=", f"{long} tel:", f"{long} "]):
        rows = [doc(i, f"{before}+1 (212) 555-{1000 + i} today") for i in range(6)] + [doc(50, f"{before}2125550199 now")]
        assert spans(spark, rows)[50] == f"phone:{len(before)}:{len(before) + 10}", before
    rows = [doc(i, f"call tel:+1 (212) 555-{1000 + i} today") for i in range(6)] + [doc(50, "call tel:2125550199 now")]
    rows += [doc(100 + i, "call tel:none") for i in range(4)]
    assert spans(spark, rows)[50] == ""


def test_a_number_that_fits_two_kinds_goes_by_its_context(spark):
    rows = [doc(i, f"ring office: +1 (212) 555-{1000 + i} today") for i in range(6)] + [doc(50, "ring office: 49301234567890 now")]
    assert not pii.base_spans(rows[-1][1]) and {k for _, k, _ in pii.loose_spans(rows[-1][1], [])} == {2, 3}
    assert spans(spark, rows)[50] == "phone:13:27"


def test_a_few_seeds_do_not_carry_a_pattern_with_many_unknown_candidates(spark):
    rows = [doc(i, f"order no +1 (212) 555-{1000 + i} today") for i in range(5)] + [doc(100 + i, f"order no {70_000_000 + i} today") for i in range(400)]
    got = spans(spark, rows)
    assert all(got[100 + i] == "" for i in range(400)) and got[0] == "phone:9:26"


def test_trust_fades_from_round_to_round(spark):
    """Each phrase hands its numbers to the next one: a chain that begins at six seeds ends before a phrase with many others."""
    rows = [doc(i, f"ring office: +1 (212) 555-{1000 + i} today") for i in range(6)] + [doc(10 + i, f"ring office: 212 555 {2000 + i} now") for i in range(8)]
    rows += [doc(100 + i, f"desk line 212 555 {2000 + i} now") for i in range(8 + 4)]
    rows += [doc(200 + i, f"bill number 212 555 {2000 + i} now") for i in range(8 + 60)]
    got = spans(spark, rows)
    assert got[111] == "phone:10:22" and got[267] == "" and got[207] == ""


def test_no_bound_on_the_length_of_an_address(spark):
    long = "a" * 70 + "(at)" + "b" * 90 + "(dot)com"
    assert pii.loose_spans(f"mail {long} now", []) == [(5, 0, 5 + len(long))]
    assert pii.loose_spans("x" * 200_000 + "(at" + "(at)" * 20_000, []) == []
    rows = [doc(i, f"mail person{i}@b.example today") for i in range(8)] + [doc(50, f"mail {long} today")]
    assert spans(spark, rows)[50] == f"email:5:{5 + len(long)}"
    assert {r.doc_id: r.text for r in pii.redact(frame(spark, rows)).collect()}[50] == "mail [EMAIL] today"


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_context(text, start):
    words = [m for m in WORD.finditer(text[:start])]
    last = words[-1][0].lower() if words else ""
    return words[-2][0].lower() if len(words) > 1 else "", last


def plain_added(rows):
    """Spans that sure patterns add, by loops over all texts."""
    texts = [t or "" for _, t, *_ in rows]
    base = [pii.base_spans(t) for t in texts]
    loose = [pii.loose_spans(t, b) for t, b in zip(texts, base)]
    name = lambda t, s, e: "".join(t[s:e].lower().split())
    graph, seeds, totals = Counter(), set(), Counter()
    for t, b, o in zip(texts, base, loose):
        for s, k, e in b + o:
            graph[k, plain_context(t, s), name(t, s, e)] += 1
        seeds |= {(k, name(t, s, e)) for s, k, e in b}
        words = [""] + [m[0].lower() for m in WORD.finditer(t)]
        for first, word, following in zip([""] + words, words, words[1:]):
            totals[first, word] += 1
            for cut in range(1, len(following)):
                totals[word, following[:cut]] += 1
    different, candidates = Counter((k, c) for k, c, _ in graph), Counter()
    for (k, c, _), n in graph.items():
        candidates[k, c] += n
    trust, late = {s: 1.0 for s in seeds}, 1.0
    while True:
        late *= pii.DAMPING
        anything = {i for _, i in trust}
        sure = {}
        for k, c in different:
            own = [(i, n) for (k2, c2, i), n in graph.items() if (k2, c2) == (k, c) and i in anything]
            hits = sum(n for i, n in own if (k, i) in trust)
            misses = sum(n for i, n in own if (k, i) not in trust)
            f = sum(trust.get((k, i), 0) for i, _ in own)
            if sum((k, i) in trust for i, _ in own) >= pii.MIN_SUPPORT:
                confidence = hits / (hits + misses + max(0, totals[c] - candidates[k, c]))
                if confidence >= pii.MIN_CONFIDENCE and round(f / different[k, c] * math.log2(f), 9) >= pii.MIN_SCORE:
                    sure[k, c] = confidence
        doubt = defaultdict(lambda: 1.0)
        for k, c, i in graph:
            if (k, c) in sure:
                doubt[k, i] *= 1 - late * sure[k, c]
        before = len(trust)
        for key, d in doubt.items():
            trust[key] = max(trust.get(key, 0), 1 - d)
        if len(trust) == before:
            break
    out = []
    for t, o in zip(texts, loose):
        met = [(s, k, e, sure[k, plain_context(t, s)]) for s, k, e in o if (k, plain_context(t, s)) in sure]
        out.append(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in pii.chosen(met)))
    return out


def planted(n=900, seed=21):
    """Texts with identifiers the fixed patterns find, identifiers they do not, and numbers that are none; and the spans of the second."""
    rng, rows, hidden = random.Random(seed), [], []
    sure = {"phone": ["ring office:", "desk line", "call tel:"], "email": ["write to", "mail <"], "ip": ["host at", "address is"]}
    other = ["order no", "batch of", "invoice number", "page 7", "the sum of"]
    for i in range(n):
        kind = rng.choice(list(sure))
        before, d = rng.choice(sure[kind]), [rng.randrange(200, 999) for _ in range(4)]
        known = {"phone": f"+1 ({d[0]}) {d[1]}-{d[2]}7", "email": f"n{d[0]}@h{d[1]}.example", "ip": f"10.{d[0] % 256}.{d[1] % 256}.{d[2] % 256}"}[kind]
        unseen = {"phone": f"{d[0]} {d[1]} {d[2]}7", "email": f"n{d[0]}(at)h{d[1]}(dot)example", "ip": f"10-{d[0] % 256}-{d[1] % 256}-{d[2] % 256}"}[kind]
        text = f"note {i % 13} says {before}{'' if before[-1] in ':<' and before[-5:] != 'fice:' else ' '}"
        if rng.random() < 0.5:
            text += f"{known} soon"
            hidden.append(set())
        else:
            hidden.append({f"{kind}:{len(text)}:{len(text) + len(unseen)}"})
            text += f"{unseen} soon"
        if rng.random() < 0.6:
            text += f" and {rng.choice(other)} {d[0]} {d[1]} {d[3]}{rng.randrange(10)} came"
        if rng.random() < 0.05:
            text += f" with {rng.choice(other)} {known} too"
        rows.append(doc(i, text))
    return rows, hidden


def test_precision_and_recall_of_added_spans(spark):
    rows, hidden = planted()
    found = pii.find(frame(spark, rows)).collect()
    added = {r.doc_id: {f"{pii.KINDS[s.kind]}:{s.start}:{s.end}" for s in r.added} for r in found}
    right = sum(len(added[i] & h) for i, h in enumerate(hidden))
    precision, recall = right / sum(map(len, added.values())), right / sum(map(len, hidden))
    print(f"added spans: precision {precision:.3f}, recall {recall:.3f}")
    assert precision >= 0.95 and recall >= 0.9


def test_rounds_and_added_spans_equal_brute_force(spark):
    rows = planted(150, 5)[0] + [r for r in make()[60:] if r[0] is not None and r[0] not in (103, 104)]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    got = {r.doc_id: ",".join(f"{pii.KINDS[s.kind]}:{s.start}:{s.end}" for s in r.added) for r in pii.find(frame(spark, rows)).collect()}
    assert [got[i] for i in range(len(rows))] == plain_added(rows)
    assert any(got.values())
