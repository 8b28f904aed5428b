"""The rows of the pipeline's run on a small corpus, against plain versions of its stages; only the classifier's decisions are taken as given."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from harborline.llm import mixing, packing, pii
from harborline.llm.common import table
from harborline.llm.queries import tokenizer
from tests.llm.rows import frame
from tests.llm.test_patterns import plain_added, planted
from tests.llm.test_sets import plain_base, toxic_rows
from tests.llm.test_similar import WORD, edited_rows, plain_kept

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(11)
    rows, labels = toxic_rows(240)
    rows += [(1000 + i, t, *more) for i, t, *more in edited_rows()[:40]]
    rows += [(2000 + i, t, *more) for i, t, *more in planted(200, 5)[0]]
    rows += [(3000 + i, rows[i][1], "en", "s2") for i in range(20)] + [(3100, None, "en", "s1"), (3101, "", "en", None), (3102, "tide " * 9000, "en", "s3")]
    return [(i, t, lang, rng.choice(["s1", "s1", "s1", "s2", "s3", "s4", None])) for i, t, lang, *_ in rows], labels


def plain_redacted(text, added):
    """The text with each stretch of overlapping spans replaced by the kind of its first one."""
    if text is None:
        return None
    order = {k: n for n, k in enumerate(pii.KINDS)}
    more = [(int(s), order[k], int(e)) for k, s, e in (x.split(":") for x in added.split(",") if x)]
    merged = []
    for start, kind, end in sorted(plain_base(text) + more):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    for start, kind, end in reversed(merged):
        text = f"{text[:start]}[{pii.KINDS[kind].upper()}]{text[end:]}"
    return text


def plain_copies(rows):
    """Copies of each id: targets by capped shares, then whole passes and one in the order of the ids' hashes."""
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    sources = {}
    for r in rows:
        sources.setdefault((r[3] is None, r[3] or ""), []).append(r[0])
    weight = {s: mixing.WEIGHTS[n % len(mixing.WEIGHTS)] for n, s in enumerate(sorted(sources))}
    total = {s: sum(size[i] for i in ids) for s, ids in sources.items()}
    held = {}
    while True:
        left, opened = sum(total.values()) - sum(held.values()), [s for s in sources if s not in held]
        share = {s: Fraction(weight[s] * left, sum(weight[o] for o in opened)) for s in opened}
        over = {s: mixing.MAX_EPOCHS * total[s] for s in opened if share[s] > mixing.MAX_EPOCHS * total[s]}
        if not over:
            break
        held.update(over)
    copies = {}
    for s, ids in sources.items():
        goal = int(float(held.get(s, share.get(s))) + 0.5)
        whole, extra = divmod(goal, max(total[s], 1))
        for i in sorted(ids, key=lambda i: hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:15]):
            part = min(max(extra, 0), size[i])
            copies[i] = whole + (part > 0 and 2 * part >= size[i])
            extra -= size[i]
    return copies


def test_rows_of_the_run_equal_plain_stages(spark, tmp_path):
    rows, labels = corpus()
    frame(spark, rows).select(*COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    harmless = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, table(spark, str(tmp_path), "documents"), str(tmp_path)).collect()}
    assert harmless < {r[0] for r in rows}
    rows = [r for r in rows if r[0] in harmless]
    kept = {i for _, i, _ in plain_kept(rows)}
    assert kept < harmless
    rows = [r for r in rows if r[0] in kept]
    clean = [(r[0], plain_redacted(r[1], a), *r[2:]) for r, a in zip(rows, plain_added(rows))]
    assert sum(a[1] != b[1] for a, b in zip(rows, clean)) > 50
    copies = plain_copies(clean)
    assert {0, 1, 3} <= set(copies.values())
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {i for i, n in copies.items() if n}
    library = Tokenizer.from_file(tokenizer(packing.TOKENIZER))
    for i, text, *_ in clean:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        covered = Counter()
        for r in (r for r in got if r.doc_id == i):
            assert r.doc_tokens == len(ids) and zlib.crc32(np.array(ids[r.start: r.start + r.length], "<u4").tobytes()) == r.ids_crc32
            covered.update(range(r.start, r.start + r.length))
        assert covered == Counter({at: copies[i] for at in range(len(ids)) if copies[i]})
