"""Language fusion and the quality classifier against plain versions of both."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import langid, nbsvm, queries

SF = "/root/testdata/sf0.001"


# 3: language of pages

def plain_fusion(pages, model):
    """(lang, probability) of (host, declared, text) by Bayes' rule, every page judged by the counts of the others."""
    n = len(model.languages)
    logs = [np.array(model.likelihood(text)) for _, _, text in pages]
    post = [np.exp(x - x.max()) / np.exp(x - x.max()).sum() for x in logs]
    groups = [(host, ".".join(host.split(".")[-2:]), host.split(".")[-1], said) for host, said, _ in pages]
    sums, total = [defaultdict(lambda: np.zeros(n)) for _ in range(4)], np.zeros(n)
    for own, p in zip(groups, post):
        total += p
        for held, key in zip(sums, own):
            held[key] += p
    out = []
    for own, x, p in zip(groups, logs, post):
        host, domain, suffix, said = [np.maximum(0, held[key] - p) for held, key in zip(sums, own)]
        rest = np.maximum(0, total - p)
        prior = (rest + 1) / (rest.sum() + n)
        for counts in (domain, host):
            prior = (counts + langid.PRIOR * prior) / (counts.sum() + langid.PRIOR)
        fused = x + np.log(prior)
        for key, counts in ((own[2], suffix), (own[3], said)):
            if key:
                fused = fused + np.log((counts + 1) / (rest + n))
        q = np.exp(fused - fused.max())
        out.append((model.languages[int(fused.argmax())], float((q / q.sum()).max())))
    return out


def page(lang, text):
    return f"<html lang={lang}><body><p>{text}</p></body></html>" if lang else f"<body>{text}</body>"


@pytest.fixture(scope="module")
def model(spark):
    return langid.train(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.fixture(scope="module")
def conflicts(spark, model):
    """Pages whose evidence disagrees: texts of each language, declared right, wrong or not at all, short or long."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang IS NOT NULL AND length(text) > 300").collect()
    texts = defaultdict(list)
    for r in docs:
        texts[r.lang].append(r.text[:1500].replace("<", " "))
    rows, wanted = [], []
    for k, lang in enumerate(sorted(texts)):
        other = sorted(texts)[(k + 1) % len(texts)]
        for i, text in enumerate(texts[lang][:12]):
            rows.append((f"http://{lang}site.example.{lang}/{i}", page(lang, text)))
            wanted.append(lang)
        rows.append((f"http://{lang}site.example.{lang}/wrong", page(other, texts[lang][0])))  # declared wrongly, a clear text
        rows.append((f"http://{lang}site.example.{lang}/short", page(None, "7 - 24!")))  # no letters, on a known host
        rows.append((f"http://{lang}site.example.{lang}/none", page(None, "")))
        wanted += [lang] * 3
        rows.append((f"http://other{k}.example.{other}/mixed", page(other, texts[lang][1])))  # text against suffix and declaration
        wanted.append(lang)
    rows += [(None, None), ("", ""), ("http://desite.example.de/x", None), ("http://desite.example.de/x", None)]
    return rows, wanted


def test_fusion_matches_plain_bayes(spark, model, conflicts):
    rows, wanted = conflicts
    df = spark.createDataFrame([(i, u, h, "x") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, lang string")
    found = {r.page_id: r for r in langid.identify(df, model).collect()}
    said = {r.page_id: r.declared or "" for r in found.values()}
    parts = []
    for i, (u, h) in enumerate(rows):
        host = (u or "").split("://")[1].split("/")[0].lower() if "://" in (u or "") else ""
        parts.append((host, said[i], langid.visible((h or "").encode())))
    plain = plain_fusion(parts, model)
    assert len(found) == len(rows)
    for i, (lang, probability) in enumerate(plain):
        assert abs(found[i].probability - probability) < 1e-9
        assert found[i].lang == lang or abs(probability - 0.25) < 1e-6
    right = [found[i].lang == lang for i, lang in enumerate(wanted)]
    assert np.mean(right) > 0.95
    # The fusion decided: pages whose text alone says nothing take their host's language.
    short = [i for i, (u, _) in enumerate(rows) if u and u.endswith(("/short", "/none"))]
    assert len(short) == 8 and sum(found[i].text_lang != wanted[i] for i in short) >= 4
    assert [found[i].lang for i in short] == [wanted[i] for i in short]


def test_query_matches_plain_bayes(spark):
    """Whole table; the model is trained as in the query."""
    docs, pages = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "pages"))
    own, rows = langid.train(docs), pages.collect()
    found = {r.page_id: r for r in queries.op3_language(spark, SF).collect()}
    parts = [(r.url.split("://")[1].split("/")[0].split("?")[0].split("#")[0].lower() if "://" in (r.url or "") else "",
              found[r.page_id].declared or "", langid.visible((r.html or "").encode())) for r in rows]
    for r, (lang, probability) in zip(rows, plain_fusion(parts, own)):
        assert found[r.page_id].lang == lang and abs(found[r.page_id].probability - probability) < 1e-9


# 7: quality

def plain_features(text):
    """The n-grams of a text as a set of cells, one by one."""
    raw, cells = (text or "").encode(), set()
    for slot, n in enumerate(nbsvm.GRAMS):
        for i in range(len(raw) - n + 1):
            code = int.from_bytes(raw[i:i + n], "big")
            if 8 * n > nbsvm.BITS:
                code = (code * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 64 - nbsvm.BITS
            cells.add((slot << nbsvm.BITS) + code)
    words = raw.split()
    same = [int(a == b) for a, b in zip(words, words[1:])]
    for n in range(1, nbsvm.REPEATS + 1):
        for i in range(len(same) - n + 1):
            cells.add((len(nbsvm.GRAMS) << nbsvm.BITS) + int("1" + "".join(map(str, same[i:i + n])), 2))
    return cells


def plain_descent(x, y, c, rounds=2000):
    """Dual coordinate ascent on the Gram matrix, in order, until nothing moves; weights with the bias last."""
    x = np.column_stack([x, np.ones(len(x))])
    gram, alpha = x @ x.T, np.zeros(len(x))
    for _ in range(rounds):
        moved = 0.0
        for i in range(len(x)):
            new = min(max(alpha[i] - (y[i] * (gram[i] @ (alpha * y)) - 1) / gram[i, i], 0.0), c[i])
            moved, alpha[i] = max(moved, abs(new - alpha[i])), new
        if moved < 1e-9:
            break
    return x.T @ (alpha * y)


def objective(w, x, y, c):
    return 0.5 * w @ w + (c * np.maximum(0, 1 - y * (np.column_stack([x, np.ones(len(x))]) @ w))).sum()


def test_fit_reaches_the_optimum_of_plain_descent():
    random = np.random.default_rng(4)
    size, rows, labels = 60, [], []
    for i in range(150):
        label = int(i % 3 == 0)
        p = np.where(np.arange(size) < 20, 0.5 if label else 0.2, 0.3)
        rows.append(np.flatnonzero(random.random(size) < p))
        labels.append(label)
    y = np.where(np.array(labels) > 0, 1.0, -1.0)
    plain = np.ones((2, size))
    for own, label in zip(rows, labels):
        for cell in own:
            plain[label][cell] += 1
    r = np.log(plain[1] / plain[1].sum()) - np.log(plain[0] / plain[0].sum())
    assert np.allclose(nbsvm.log_count_ratio(rows, y, size), r)
    x = np.zeros((len(rows), size))
    for i, own in enumerate(rows):
        x[i, own] = r[own] / math.sqrt(len(own))
    c = np.where(y > 0, 1 / (2 * np.mean(y > 0)), 1 / (2 * np.mean(y < 0)))
    best = plain_descent(x, y, c)
    found = nbsvm.fit(rows, labels, size)
    own = np.append(np.divide(found.weights, r, out=np.zeros(size), where=r != 0), found.bias)
    assert objective(own, x, y, c) <= 1.01 * objective(best, x, y, c)
    margins = [(x[i] @ best[:-1] + best[-1]) for i in range(len(x))]
    assert np.mean(np.sign(margins) == np.sign(x @ own[:-1] + own[-1])) > 0.97


def test_query_scores_by_plain_features(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    own = nbsvm.train(docs, labels, keep=~held)
    found = {r.doc_id: r for r in queries.op7_nbsvm(spark, SF).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    for r in rows:
        cells = sorted(plain_features(r.text))
        margin = sum(own.weights[c] for c in cells) / math.sqrt(max(1, len(cells))) + own.bias
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, own.scale * margin + own.shift))))
        got = found[r.doc_id]
        assert abs(got.score - score) < 1e-9 and got.predicted == int(got.score >= 0.5)
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
