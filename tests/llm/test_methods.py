"""The operators by their own interfaces: against brute force, planted cases and other tokenizers."""

import json
import math
import random
from collections import Counter, defaultdict

import pytest
from brute import best_window, fingerprint, groups, norm_words, shingles, similarity
from pyspark.sql import functions as F

from churnlab.llm import queries as Q
from churnlab.llm.common import saved, table

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# ------------------------------------------------------- all: clashing columns
CLASH = ("row", "h", "shard", "slot", "kept", "score", "rule", "host", "verdict", "epoch", "license", "spans", "id", "hash",
         "tokens", "block", "n", "key", "fp", "base", "weak", "item", "l", "p", "lang_", "words", "Fingerprint", "COMPONENT_ID")


@pytest.fixture(scope="module")
def clashing(spark):
    docs = table(spark, SF, "documents").limit(60)
    extra = [F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASH]
    url = F.concat(F.lit("http://a.example.org/en/"), F.col("doc_id"))
    return saved(docs.select("*", url.alias("url"), F.concat_ws("/", "source", "doc_id").alias("path"), *extra), "clash")


def _operators(spark):
    from churnlab.llm import decontaminate, licenses, mixing, near_dup, quality, secret_scan, sharding, token_count, url_filter
    bench = spark.createDataFrame([(1, "nothing of the kind in any of these documents")], "item_id long, text string")
    rules = url_filter.rule_table(spark, [("block", "org/en/")])
    return {
        "shard": lambda df: sharding.uniform_shards(df, 3), "url": lambda df: url_filter.judge_urls(df, rules),
        "secret": secret_scan.scan_secrets, "quality": quality.judge_quality, "license": licenses.scan_licenses,
        "mix": lambda df: mixing.mix_sources(df, entropy=None, repetition=None),
        "tokens": lambda df: token_count.add_token_count(df, [("<unk>", 0.0), ("a", -1.0), ("▁", -2.0)]),
        "clean": lambda df: decontaminate.without_contaminated(df, bench),
        "component": lambda df: near_dup.add_component(saved(near_dup.add_fingerprint(df, name="print"), "t"), print_col="print"),
        "one": near_dup.one_of_each,
    }


@pytest.mark.parametrize("name", ["shard", "url", "secret", "quality", "license", "mix", "tokens", "clean", "component", "one"])
def test_clashing_columns(spark, clashing, name):
    out = _operators(spark)[name](clashing)
    lower = [c.lower() for c in out.columns]
    assert len(lower) == len(set(lower))
    n = clashing.count()
    rows = rows_of(out)
    assert len(rows) == n if name != "one" else 0 < len(rows) <= n
    for r in rows:
        for c in CLASH:
            if c in r and isinstance(r[c], str) and r[c].startswith(f"{c}-"):
                assert r[c] == f"{c}-{r['doc_id']}"
    kept = [c for c in CLASH if rows and all(str(r.get(c)).startswith(f"{c}-") for r in rows)]
    assert len(kept) >= len(CLASH) - 5


# ------------------------------------------------------------------ decontamination
def _found(df):
    best = {}
    for r in rows_of(df):
        best[(r["doc_id"], r["item_id"])] = r["similarity"]
    return best


def test_decontamination_equals_brute_force(spark):
    items = {r["item_id"]: r["text"] for r in rows_of(table(spark, SF, "benchmark"))}
    want = {}
    for d in rows_of(table(spark, SF, "documents")):
        for i, text in items.items():
            s = best_window(d["text"], text)
            if s is not None and s >= 0.8:
                want[(d["doc_id"], i)] = round(s, 9)
    assert _found(Q.op1_decontamination(spark, SF)) == want and want


def test_decontamination_finds_edited_passages(spark):
    from churnlab.llm.decontaminate import contaminated
    r = random.Random(3)
    pool = [f"w{i}" for i in range(900)]
    items = [(i, " ".join(r.choices(pool, k=n))) for i, n in enumerate([3, 5, 6, 9, 15, 30, 59, 120])]
    items += [(20, items[5][1]), (21, None), (22, " .,; "), (23, "the the the the the the the the")]
    docs = []
    for i, text in items[:8]:
        ws = text.split()
        for edits in range(4):
            for _ in range(6):
                mine = list(ws)
                for _ in range(edits):
                    at = r.randrange(len(mine)) if mine else 0
                    what = r.choice("idr")
                    if what == "i":
                        mine.insert(at, "new")
                    elif what == "d" and len(mine) > 1:
                        del mine[at]
                    else:
                        mine[at] = "other"
                before, after = (r.choices(pool, k=r.choice([0, 3, 40])) for _ in range(2))
                docs.append((len(docs), " ".join([*before, *mine, *after]).upper().replace(" ", ", ")))
    docs += [(900, None), (901, ""), (902, "the " * 30), (903, "the " * 3), (903, "the " * 30), (903, "the " * 30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.id, x.item_id): round(x.similarity, 9) for x in contaminated(df, bench).collect()}
    want = {}
    for d, text in docs:
        for i, item in items:
            s = best_window(text, item)
            if s is not None and s >= 0.8 - 1e-12:
                want[(d, i)] = round(s, 9)
    assert len(want) > 60
    assert got == want


def test_benchmark_in_several_passes(spark, monkeypatch):
    from churnlab.llm import decontaminate as D
    whole = _found(Q.op1_decontamination(spark, SF))
    monkeypatch.setattr(D, "SLICE", 300)
    assert _found(Q.op1_decontamination(spark, SF)) == whole


def test_windows_meet_the_index_as_numbers(spark, monkeypatch):
    """A window meets the index once per block: what is repeated so holds no words, shingles or item texts."""
    from churnlab.llm import decontaminate as D
    asked, written = [], D.saved

    def nodes(plan):
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    def watch(df, name):
        if name in ("bench-index", "bench-verified"):
            asked.extend(n.schema().json() for n in nodes(df._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Generate")
        return written(df, name)

    monkeypatch.setattr(D, "saved", watch)
    words = [f"w{i}" for i in range(40)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words)), (3, "other words than those of the documents")],
                                  "item_id long, text string")
    docs = [(1, " ".join(["so", *words, "end"])), (2, " ".join([*words[:38], "new", *words[38:]])), (3, "nothing of it"), (None, " ".join(words))]
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert sorted((r["id"] or 0, r["item_id"], r["at"]) for r in got.collect()) == [(i, n, int(i == 1)) for i in (0, 1, 2) for n in (1, 2)]
    assert len(asked) == 3
    for schema in asked:
        assert {str(f["type"]) for f in json.loads(schema)["fields"]} <= {"long", "integer"}


# --------------------------------------------------------------------- token counts
def _unigram(pieces, byte_fallback):
    from tokenizers import Tokenizer, models
    return Tokenizer(models.Unigram(list(pieces), unk_id=0, byte_fallback=byte_fallback))


def test_token_counts_equal_the_tokenizer(spark):
    from churnlab.llm.token_count import SPACE, read_vocabulary
    pieces, _ = read_vocabulary(Q.TOKENIZER)
    tokenizer = _unigram(pieces, True)
    got = Counter((r["doc_id"], r["n_tokens"]) for r in rows_of(Q.op2_token_count(spark, SF)))
    want = Counter()
    for d in rows_of(table(spark, SF, "documents")):
        line = SPACE + d["text"].replace(" ", SPACE) if d["text"] else ""
        want[(d["doc_id"], len(tokenizer.encode(line, add_special_tokens=False).ids) if line else 0)] += 1
    assert got == want


def test_token_count_ties_and_unknowns():
    from churnlab.llm.token_count import SPACE, PieceCounter
    r = random.Random(8)
    byte = [(f"<0x{b:02X}>", 0.0) for b in range(256)]
    for trial in range(60):
        alphabet = "ab" + SPACE + ("c" if trial % 2 else "")
        names = sorted({"".join(r.choices(alphabet, k=r.randint(1, 4))) for _ in range(r.randint(1, 14))})
        pieces = [("<unk>", 0.0), *((n, -float(r.randint(1, 4))) for n in names)]
        fallback = trial % 3 == 0
        if fallback:
            pieces += byte
        counter, tokenizer = PieceCounter(pieces), _unigram(pieces, fallback)
        for _ in range(40):
            text = "".join(r.choices("abcé \n", k=r.randint(1, 14)))
            line = SPACE + text.replace(" ", SPACE)
            assert counter.count(text)[0] == len(tokenizer.encode(line, add_special_tokens=False).ids), (pieces, text)
    assert counter.count(None) == counter.count("") == (0, 0.0)


# --------------------------------------------------------------------------- mixing
def _mix_rows(spark, sizes, seed=1):
    r = random.Random(seed)
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, source, " ".join(["w"] * r.randint(1, 60))))
            i += 1
    return rows


@pytest.mark.parametrize("options", [{"entropy": 0.9, "repetition": None}, {"entropy": None, "repetition": 2.5},
                                     {"entropy": 0.99, "repetition": 3.0, "budget": 1.7}, {"entropy": 0.98, "budget": 0.3}])
def test_mixing(spark, options):
    from churnlab.llm.mixing import mix_sources
    rows = _mix_rows(spark, {"big": 900, "mid": 200, "small": 30, None: 25}) + [(5000, "big", None), (5001, "none", ""), (5002, "none", " ")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = rows_of(mix_sources(df, block_rows=50, **options))
    tokens, size, total = {}, defaultdict(int), 0
    for i, s, t in rows:
        tokens[i] = len((t or "").split())
        size[s] += tokens[i]
        total += tokens[i]
    size.pop("none")
    budget = options.get("budget", 1.0)

    def weights(a):
        w = {s: (n / total) ** a for s, n in size.items()}
        return {s: x / sum(w.values()) for s, x in w.items()}

    def entropy(a):
        return -sum(p * math.log(p) for p in weights(a).values()) / math.log(len(size))

    def repeats(a):
        return max(budget * total * p / size[s] for s, p in weights(a).items())

    def bisect(holds):
        lo, hi = 0.0, 1.0
        if holds(1.0):
            return 1.0
        for _ in range(80):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if holds(mid) else (lo, mid)
        return lo

    alpha = 0.0
    if options.get("entropy"):
        alpha = bisect(lambda a: entropy(a) >= options["entropy"])
    limit = options.get("repetition", 4.0)
    if limit and repeats(0.0) > limit:
        alpha = max(alpha, bisect(lambda a: repeats(a) > limit))
    per_doc, spent = Counter(), defaultdict(int)
    for g in got:
        per_doc[g["doc_id"]] += 1
        spent[g["source"]] += tokens[g["doc_id"]]
    assert "none" not in spent
    for s, p in weights(alpha).items():
        due = budget * total * p
        assert due - 2 <= spent[s] <= due + 60
        counts = {per_doc[i] for i, src, _ in rows if src == s and tokens[i]}
        assert max(counts) - min(counts) <= 1
    for i in per_doc:
        assert sorted(g["epoch"] for g in got if g["doc_id"] == i) == list(range(per_doc[i]))


def test_mixing_whole_query(spark):
    docs = rows_of(table(spark, SF, "documents"))
    got = rows_of(Q.op3_mixing(spark, SF))
    total = sum(len((d["text"] or "").split()) for d in docs)
    assert abs(sum(g["tokens"] for g in got) - total) < 0.2 * total
    assert {g["doc_id"] for g in got} <= {d["doc_id"] for d in docs}


# ------------------------------------------------------------------------- licences
def _licenses(files, templates, threshold=0.75):
    """Every line against every template, then the folders upwards."""
    import re
    terms = lambda t: re.findall(r"[^\W_]+", t.lower())
    vocabulary = {w for _, t in templates for w in terms(t)}
    held = Counter(w for _, t in files for w in set(terms(t or "")) & vocabulary)
    idf = lambda w: math.log((1 + len(files)) / ((1 + held[w]) if w in vocabulary else 2)) + 1
    vector = lambda t: {w: n * idf(w) for w, n in Counter(terms(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    goals = [(n, vector(t)) for n, t in templates]

    def best(line):
        v = vector(line)
        scored = [(-round(sum(x * g.get(w, 0) for w, x in v.items()) / (norm(v) * norm(g)), 9), n) for n, g in goals] if v else []
        return min(scored, default=(0, None))

    own, granted = {}, {}
    for k, (path, text) in enumerate(files):
        file = bool(re.match("(?i)(licen[sc]e|copying|notice)([._-].*)?$", path.rpartition("/")[2]))
        s, n = min([best(x) for x in [*(text or "").split("\n"), *([text or ""] if file else [])]])
        if -s >= threshold:
            own[k] = (n, -s, "file" if file else "header", None)
            if file:
                top = path.rpartition("/")[0]
                granted[top] = min(granted.get(top, (0, "~")), (s, n))
    out = []
    for k, (path, _) in enumerate(files):
        got = own.get(k, (None, None, None, None))
        up = path.rpartition("/")[0]
        while got[0] is None:
            if up in granted:
                got = (granted[up][1], -granted[up][0], "inherited", up)
            if not up:
                break
            up = up.rpartition("/")[0]
        out.append((path, *got))
    return out


def _rounded(rows):
    return Counter((p, n, None if s is None else round(s, 6), b, d) for p, n, s, b, d in rows)


def test_licenses_equal_brute_force(spark):
    from churnlab.llm.licenses import TEMPLATES
    got = rows_of(Q.op4_licenses(spark, SF))
    text = {d["doc_id"]: d["text"] for d in rows_of(table(spark, SF, "documents"))}
    want = _licenses([(g["path"], text[g["doc_id"]]) for g in got], TEMPLATES)
    assert _rounded(want) == _rounded((g["path"], g["license"], g["score"], g["basis"], g["license_dir"]) for g in got)


def test_licenses_are_inherited_from_the_nearest_folder(spark):
    from churnlab.llm.licenses import TEMPLATES, scan_licenses
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [("a/LICENSE", mit), ("a/b/c/x.py", "code"), ("a/b/LICENSE.txt", apache), ("a/y.py", None), ("z.py", "none"),
             ("a/b/own.py", f"# first line\n{mit.upper()}\nrest"), ("ab/x.py", "the license of my car is blue"),
             ("a/b/c/d/COPYING", "nothing"), ("a/b/c/d/q.py", ""), ("a/e/NOTICE", mit), ("a/e/COPYING", apache), ("a/e/f.py", "x")]
    df = spark.createDataFrame(files, "path string, text string")
    got = [(r.path, r.license, r.score, r.basis, r.license_dir) for r in scan_licenses(df).collect()]
    assert _rounded(got) == _rounded(_licenses(files, TEMPLATES))
    by = {g[0]: (g[1], g[3], g[4]) for g in got}
    assert by["a/b/c/x.py"] == ("Apache-2.0", "inherited", "a/b") and by["a/y.py"] == ("MIT", "inherited", "a")
    assert by["a/b/own.py"][:2] == ("MIT", "header") and by["z.py"] == by["ab/x.py"] == (None, None, None)


# ------------------------------------------------------------------------- sharding
def test_hypergeometric_draws_by_inversion(spark):
    from churnlab.llm.sharding import hypergeometric
    for total, marked, drawn in ((50, 20, 13), (9, 9, 4), (9, 0, 4), (1, 1, 1), (30, 4, 30), (200, 100, 100)):
        df = spark.range(400).select(((F.col("id") + 0.5) / 400).alias("u"))
        got = df.select("u", hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), F.col("u")).alias("k")).collect()
        for r in got:
            cum, k = 0.0, max(0, drawn - (total - marked)) - 1
            while cum <= r.u and k < min(marked, drawn):
                k += 1
                cum += math.comb(marked, k) * math.comb(total - marked, drawn - k) / math.comb(total, drawn)
            assert r.k == k, (total, marked, drawn, r)


def test_matrix_has_exact_margins_and_equal_rows_spread(spark):
    from churnlab.llm.sharding import communication_matrix, uniform_shards
    r = random.Random(2)
    sizes = [(i, r.choice([1, 5, 70, 400])) for i in range(90)]
    total = sum(n for _, n in sizes)
    rows = communication_matrix(spark.createDataFrame(sizes, "block int, n long"), 7, total, 5).collect()
    assert {x.block: sum(x.counts) for x in rows} == dict(sizes)
    columns = [sum(x.counts[s] for x in rows) for s in range(7)]
    assert columns == [total // 7 + (s < total % 7) for s in range(7)]
    same = spark.createDataFrame([(1, "x")] * 700, "doc_id long, text string")
    spread = Counter(x.shard for x in uniform_shards(same, 7).collect())
    assert set(spread.values()) == {100}


def test_sharding_query_deals_whole_documents(spark):
    from churnlab.llm.sharding import uniform_shards
    whole = uniform_shards(table(spark, SF, "documents"), 24).select("doc_id", "shard", "slot")
    got = Q.op5_sharding(spark, SF).select("doc_id", "shard", "slot")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, whole.collect()))


# ------------------------------------------------------------------------- secrets
def test_long_secrets_are_parts(spark):
    from churnlab.llm.secret_scan import scan_secrets
    r = random.Random(5)
    run = "".join(r.choices("GHIJKLMNOPqrstuvwxyz0123456789+/", k=86))
    url, far = "https://acme.blob.example.net", "x" * 3000 + "7"
    texts = [f"DefaultEndpointsProtocol=https;AccountName=acme;AccountKey={run}==;BlobEndpoint={url}/",
             f"{url} {far}", f"{url} {'+' * 2999}7q", f"only {run}==", f"{run}== {'y ' * 150}{url}",
             f"{url} {run}===", f"{url} {'x' * 88}", f"{url} {'7' * 88}", f"{url} {'Zx9+' * 100_000}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.spans for x in scan_secrets(df).collect()}
    key, end = texts[0].index(run), texts[0].index(url)
    assert got[0] == f"secret:{key}:{key + 88},endpoint:{end}:{end + len(url)}"
    n = len(url)
    assert got[1] == got[2] == f"endpoint:0:{n},secret:{n + 1}:{n + 3002}"
    assert got[3] == got[4] == got[5] == got[6] == ""
    assert "secret" not in got[7]
    assert got[8] == f"endpoint:0:{n},secret:{n + 1}:{n + 400_001}"


# ----------------------------------------------------------------- quality and WARC
def test_perplexity_bands_reject_garbled_texts(spark):
    from churnlab.llm.quality import judge_quality
    r = random.Random(4)
    words = ["the", "river", "house", "mountain", "answer", "window", "garden", "never", "always", "people"]
    rows = [(i, " ".join(r.choices(words, k=80)), "en") for i in range(200)]
    rows += [(900 + i, " ".join("".join(r.choices("qxzjkvw#%@", k=6)) for _ in range(80)), "en") for i in range(3)]
    rows += [(950, " ".join(r.choices(words, k=80)), None), (951, "too few words", "xx")]
    got = {x.doc_id: x.kept for x in judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i] for i in range(200)) and not any(got[900 + i] for i in range(3))
    assert got[950] and not got[951]


def test_bands_reject_wrong_language_and_mildly_garbled_texts(spark):
    """Long texts are held to the deviations of their language; short clean ones are not rejected for being short."""
    from churnlab.llm.quality import judge_quality
    r = random.Random(11)
    parts = {"en": ["th", "er", "ing", "an", "wh", "ed", "ou", "sh", "ly", "st"],
             "fr": ["é", "eau", "eux", "ch", "le", "qu", "oi", "tr", "ai", "è"]}
    words = {lang: ["".join(r.choices(p, k=r.randint(1, 3))) for _ in range(300)] for lang, p in parts.items()}

    def text(lang, k):
        return " ".join(r.choices(words[lang], k=k))

    def garbled(t, share):
        return "".join(r.choice("aeiourstln") if c != " " and r.random() < share else c for c in t)

    rows = [(i, text(lang, r.randint(100, 300)), lang) for i, lang in enumerate(["en"] * 300 + ["fr"] * 300)]
    rows += [(1000 + i, text(lang, 22), lang) for i, lang in enumerate(["en", "fr"] * 10)]
    rows += [(2000, text("en", 150), "fr"), (2001, text("fr", 150), "en")]
    rows += [(3000 + i, garbled(text(lang, 200), 0.15), lang) for i, lang in enumerate(["en", "fr"] * 2)]
    rows += [(4000, text("en", 100), "x"), (4001, text("fr", 100), "x")]
    got = {x.doc_id: x for x in judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not any(x.base_failed for x in got.values())
    assert all(x.kept == (i < 2000 or i >= 4000) for i, x in got.items()), [(i, x.kept, x.score) for i, x in got.items() if i >= 1000]


def test_kneser_ney_is_a_distribution(spark):
    """The probabilities equal a plain version's, and those after a context add up to one with the unseen rest."""
    from churnlab.llm import quality as L
    df = spark.createDataFrame([("en", "abracadabra abra cadabra " * 3), ("en", "barbara")], "lang string, text string")
    counts = L.count_grams(df)
    model = {r.gram: math.exp(r.logp) for r in L.kneser_ney(counts).collect()}
    top = {r.gram: r.n for r in counts.collect()}
    types = {4: top}
    for k in (3, 2, 1):
        types[k] = Counter(g & ((1 << 16 * k) - 1) for g in types[k + 1])

    def cuts(t):
        n = Counter(t.values())
        if not (n[1] and n[2] and n[3]):
            return {1: 0.5, 2: 0.5, 3: 0.5}
        y = n[1] / (n[1] + 2 * n[2])
        return {i: max(0.0, min(float(i), i - (i + 1) * y * n[i + 1] / n[i])) for i in (1, 2, 3)}

    def p(k, gram):
        if k == 0:
            return 1 / len(types[1])
        t, d = types[k], cuts(types[k])
        mates = [g for g in t if g >> 16 == gram >> 16]
        whole = sum(t[g] for g in mates)
        freed = sum(d[min(3, t[g])] for g in mates)
        return ((t[gram] - d[min(3, t[gram])]) if gram in t else 0) / whole + freed / whole * p(k - 1, gram & ((1 << 16 * (k - 1)) - 1))

    assert set(model) == set(top)
    assert all(abs(model[g] - p(4, g)) < 1e-9 for g in top)


def test_model_in_several_slices_scores_alike(spark, monkeypatch):
    from churnlab.llm import quality as L
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang").limit(40)
    whole = {r.doc_id: (r.kept, round(r.score, 6)) for r in L.judge_quality(docs).collect()}
    monkeypatch.setattr(L, "SLICE", 4000)
    monkeypatch.setattr(L, "GATHER", 3000)
    monkeypatch.setattr(L, "HOLD", 500)
    assert {r.doc_id: (r.kept, round(r.score, 6)) for r in L.judge_quality(docs).collect()} == whole


def test_archive_round_trip(spark):
    from churnlab.llm.warc import read_archive, write_archive
    from churnlab.session import work_path
    rows = [(1, "http://a/\r\nX: y", "p" * 150), (2, None, "p" * 150), (3, "http://b", "ü€\r\n\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = write_archive(df, work_path(spark, "t-warc"))
    got = {r.page_id: r for r in read_archive(spark, path).collect()}
    assert [bytes(got[i].payload).decode() for i in (1, 2, 3)] == [r[2] for r in rows]
    assert got[1].url == rows[0][1] and "\r\nX: y" not in got[1].header
    for i, r in got.items():
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        length = int(head.decode().rpartition("Content-Length: ")[2])
        assert len(body) == length + 4 and body.endswith(b"\r\n\r\n")
        assert bytes(r.payload) == body[:length].partition(b"\r\n\r\n")[2] or i == 2
    assert spark.read.parquet(f"{path}/payloads").count() == 2
    # a damaged payload is noticed
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit("zz").cast("binary"))
    other = work_path(spark, "t-warc")
    bad.write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{other}/headers")
    with pytest.raises(Exception, match="missing or damaged"):
        read_archive(spark, other).collect()


# ------------------------------------------------------------------------- pipeline
def test_pipeline_stages_equal_brute_force(spark):
    import corpus_pipeline as P
    docs = table(spark, SF, "documents")
    columns = docs.columns
    items = [r["text"] for r in rows_of(table(spark, SF, "benchmark"))]
    key = lambda rs: Counter((r["doc_id"], r["text"]) for r in rs)
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    steps = {}
    for name, stage in P.STAGES:
        docs = saved(stage(spark, docs, SF), f"t-{name}")
        steps[name] = rows_of(docs)
        assert docs.columns == columns + (["shard", "slot"] if name == "sharding" else [])
    kept = {r["doc_id"] for r in rows_of(Q.op9_quality(spark, SF)) if r["kept"]}
    assert {r["doc_id"] for r in steps["quality"]} == kept
    prints = [(r["doc_id"], fingerprint(r["text"])) for r in steps["quality"]]
    group = groups(prints)
    assert {r["doc_id"] for r in steps["near_duplicates"]} == {i for i, p in prints if group[p] == i}
    clean = {r["doc_id"] for r in steps["near_duplicates"]
             if not any((best_window(r["text"], t) or 0) >= 0.8 for t in items)}
    assert {r["doc_id"] for r in steps["decontamination"]} == clean
    size = sum(len(r["text"].split()) for r in steps["decontamination"])
    mixed = sum(len(r["text"].split()) for r in steps["mixing"])
    assert abs(mixed - size) < 0.2 * size and set(key(steps["mixing"])) <= set(key(steps["decontamination"]))
    assert key(steps["sharding"]) == key(steps["mixing"])
    shards = Counter(r["shard"] for r in steps["sharding"])
    assert max(shards.values()) - min(shards[s] for s in range(24)) <= 1
    slots = defaultdict(list)
    for r in steps["sharding"]:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_of_each_keeps_one_row(spark):
    from churnlab.llm.near_dup import one_of_each
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(5, long), (3, long), (3, long), (None, long), (9, long + " tail"), (7, None), (8, ""), (None, "other words here today"),
            (None, "other words here today")]
    got = rows_of(one_of_each(spark.createDataFrame(rows, "doc_id long, text string")))
    want = groups([(i if i is not None else 10**6, fingerprint(t)) for i, t in rows])
    assert len(got) == len(set(want.values()))
    assert Counter((g["doc_id"], g["text"]) for g in got)[(3, long)] == 1
