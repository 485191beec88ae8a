"""Documents with everything that may be odd about a table."""

import random

CLASHES = (
    "key, digest, size, source_size, target, repeats, n_lines, n_dropped, n_words, n_removed, spans, items, kept, "
    "perplexity, loss, threshold, n_tokens, log_likelihood, hash, place, row, fp, root, a, b, node, host, path, rule, verdict, places, at, number, "
    "__key, __places, __at0, __id, __digest, __drops, __gone, __url, __found, __lang, __mean, __threshold, __plan_source, "
    "stays_id, stays_digest, dropped_id, drops, plan_source, plan_cut, copy, judged_url, found, own_lang, own_mean, own_threshold"
).split(", ")
COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
WIDE = COLUMNS + ", " + ", ".join(f"{c} STRING" for c in CLASHES)


def sentence(rng, n, words=40):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def documents(seed=0, n=60):
    """Rows (doc_id, text, lang, source, n_chars): copies, near copies, shared lines and passages, a hot source,
    nulls, empty and blank texts, a long text, repeated rows."""
    rng = random.Random(seed)
    shared = [sentence(rng, 14) for _ in range(4)]
    passage = sentence(rng, 60)
    texts = [None, "", " \n\t\n ", "a", "Ümläut ÄÖ é", "x\ny\nx", sentence(rng, 4000), "\n".join(shared * 3), passage]
    while len(texts) < n:
        kind = rng.randrange(6)
        if kind == 0:
            texts.append(rng.choice(texts))
        elif kind == 1:
            texts.append((rng.choice(texts) or "").upper())
        elif kind == 2:
            texts.append("\n".join([sentence(rng, 12), rng.choice(shared), sentence(rng, 9)]))
        elif kind == 3:
            texts.append(sentence(rng, rng.randrange(5, 50)) + " " + passage + "  " + sentence(rng, 8))
        elif kind == 4:
            words = (rng.choice(texts) or "a b c d e f g h i j k").split()
            words[rng.randrange(len(words)) if words else slice(0)] = "changed" if words else []
            texts.append(" ".join(words))
        else:
            texts.append("\n".join(sentence(rng, rng.randrange(1, 30)) for _ in range(rng.randrange(1, 6))))
    rng.shuffle(texts)
    rows = [
        (i * 3, t, rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "s1", "s2", None]), len(t or ""))
        for i, t in enumerate(texts)
    ]
    return rows


def odd_rows(seed=0):
    """The same with null ids and repeated rows."""
    rows = documents(seed)
    rng = random.Random(seed)
    return rows + rng.sample(rows, 5) + [(None, t, None, None, None) for _, t, *_ in rng.sample(rows, 4)] + [(None, None, None, None, None)] * 2


def frame(spark, rows, wide=False):
    if wide:
        return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], WIDE).repartition(3)
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
