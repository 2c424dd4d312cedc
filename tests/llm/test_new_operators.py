"""Token alignment, spelling variants and chat formatting against brute force and round trips; texts with many matches."""

import hashlib
import json
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from churnlab.llm import align_tokens as A
from churnlab.llm import chat_format as C
from churnlab.llm import queries as Q
from churnlab.llm import spelling as S
from churnlab.llm.common import LOWER, UPPER, running_sum, table

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, root, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Nulls, blanks, long texts, repeated rows and ids, characters of several bytes, texts that do not come back."""
    r = random.Random(2)
    long = " ".join(r.choice(["wörd", "gespräch", "running", "runing", "😀x", "naïve", "ver-ylong"]) for _ in range(30_000))
    texts = [None, "", " ", "  two  spaces ", "a\tb\n\n c", "tail   ", long, long, "y" * 4000, "ünï cödé 😀😀 ​x", "has ▁ in it",
             "<s>control</s> <|endoftext|>", "é combining", "퟿ \U0010ffff", "house houses house hause", "house houses hause",
             "HOUSE Houses hause", "same text", "same text", "ﬁ ligature ½", "\x00 nul", "日本語のテキスト 한국어"]
    rows = [(i if i != 3 else None, t, "en", "s", 1) for i, t in enumerate(texts)] + [(5, "again", None, None, None)] * 2
    root = tmp_path_factory.mktemp("odd3")
    write(spark, root, "documents", rows, ODD)
    chat = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|> <\\|x <| \\<||"), (2, 0, "user", None), (2, 1, "assistant", None),
            (3, 1, "assistant", "first?"), (3, 0, "system", "s"), (3, None, "user", "no turn"), (4, 0, None, "no role"), (5, 0, "we%ird\nrole", "x"),
            (6, 0, "tool", "t"), (6, 0, "tool", "t"), (None, 0, "user", "no id"), (None, 0, "assistant", "no id either"),
            (7, 0, "human", "kept"), (7, 1, "gpt", "as they are"), (-5, 0, "user", "neg"), (-5, 1, "assistant", "ative <")]
    chat += [(8, i, "user" if i % 2 == 0 else "assistant", f"turn {i} <|é😀" * (i % 3)) for i in range(1000)]
    chat += [(9, 0, "user", "u"), (9, 1, "assistant", "long " * 200_000)]
    chat += [(100 + i, j, role, f"{i} {j}") for i in range(30) for j, role in enumerate(("system", "user", "assistant")[i % 2:])]
    write(spark, root, "conversations", chat, "conv_id long, turn long, role string, text string")
    return str(root)


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("empty3")
    for name in ("documents", "conversations"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.fixture(params=["small", "odd"])
def some_dir(request, odd_dir):
    return SF if request.param == "small" else odd_dir


def test_running_sum(spark):
    for n in (0, 1, 255, 256, 257, 5000):
        xs = [(i * 7919) % 23 for i in range(n)]
        got = spark.createDataFrame([(xs,)], "x array<long>").select(running_sum(F.col("x")).alias("s")).first().s
        assert got == [sum(xs[:i]) for i in range(n)] if n < 300 else got[-1] == sum(xs[:-1]) and len(got) == n


# ----------------------------------------------------------------------- op11
def brute_tokens(text, a, b):
    """(ids, byte ends) of both tokenizers, or None."""
    if not text:
        return None
    table = A.byte_of_char()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    said_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
    said_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        m = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        said_b.append(bytes([int(m[1], 16)]) if m else piece.replace("▁", " ").encode())
    line = (" " + text).encode()
    if b"".join(said_a) != line or b"".join(said_b) != line:
        return None
    ends = [[sum(map(len, said[:i + 1])) for i in range(len(said))] if len(said) < 2000 else None for said in (said_a, said_b)]
    for k, said in enumerate((said_a, said_b)):
        if ends[k] is None:
            at, ends[k] = 0, []
            for s in said:
                at += len(s)
                ends[k].append(at)
    return ids_a, ends[0], ids_b, ends[1]


def test_alignment(spark, some_dir):
    import sentencepiece
    import tokenizers
    a = tokenizers.Tokenizer.from_file(Q.BYTE_TOKENIZER)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=Q.TOKENIZER)
    rows, counts = [], Counter()
    for d in table(spark, some_dir, "documents").collect():
        got = brute_tokens(d.text, a, b)
        if got is None:
            rows.append((d.doc_id, 0, 0, 0, [], ""))
            continue
        ids_a, ends_a, ids_b, ends_b = got
        both = sorted(set(ends_a) & set(ends_b))
        groups, i, j, links, k = [], 0, 0, [], 0
        for cut in both:
            i2, j2 = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            groups.append(",".join(map(str, ids_a[i:i2])) + "|" + ",".join(map(str, ids_b[j:j2])))
            for x in range(i, i2):  # overlaps lie within a group
                for y in range(j, j2):
                    if max(([0] + ends_a)[x], ([0] + ends_b)[y]) < min(ends_a[x], ends_b[y]):
                        links.append((ids_a[x], ids_b[y]))
            i, j = i2, j2
        counts.update(links)
        rows.append((d.doc_id, len(ids_a), len(ids_b), len(both), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (x, y), n in counts.items():
        best[y] = max(best[y], n)
    want = Counter((i, na, nb, ng, len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), h)
                   for i, na, nb, ng, ls, h in rows)
    assert Counter(tuple(r) for r in Q.op11_token_alignment(spark, some_dir).collect()) == want
    if some_dir != SF:
        assert any(r[1] == 0 and r[5] == "" for r in rows) and sum(r[1] > 0 for r in rows) > 15


def test_alignment_forgets_pieces_without_changing_results(monkeypatch):
    monkeypatch.setattr(A, "KNOWN", 3)
    monkeypatch.setattr(A, "AT_A_TIME", 2)
    small = A.Aligner(Q.BYTE_TOKENIZER, Q.TOKENIZER)
    monkeypatch.setattr(A, "KNOWN", 10_000)
    large = A.Aligner(Q.BYTE_TOKENIZER, Q.TOKENIZER)
    texts = ["one two three one", "two two four é😀 five", None, "one ▁ two", "five six one"] * 3
    assert list(small.texts(texts)) == list(large.texts(texts))
    assert len(small.young) <= 12


def test_alignment_in_lines_is_that_of_single_pieces():
    al = A.Aligner(Q.BYTE_TOKENIZER, Q.TOKENIZER)
    texts = ["one  two é😀 x1  \n", "  ", "it's don 't\u00a0a\u3000b", "▁ bad", " \n lead", "<|endoftext|> <s> \t<0x41>", "naïve 中文 字", "\r\n a"]
    texts += [f"w{i} ▁{i}" if i % 40 == 0 else f"w{i} {i}ö" for i in range(200)]
    pieces = list(dict.fromkeys(p for t in texts for p in al.pieces(t)))
    single = al.align(pieces, 1)
    assert al.align(pieces) == single and al.align(pieces, 7) == single
    assert sum(x is None for x in single) >= 6
    whole = A._aligned(al, [t for t in texts if "▁" not in t]).to_pylist()
    al.cuts = False
    al.young, al.old = {}, {}
    assert A._aligned(al, [t for t in texts if "▁" not in t]).to_pylist() == whole


def test_alignment_gives_many_pieces_to_the_tokenizers_at_once():
    al = A.Aligner(Q.BYTE_TOKENIZER, Q.TOKENIZER)
    given, real = [], al.a

    class Counted:
        def encode_batch(self, lines, **how):
            given.extend(lines)
            return real.encode_batch(lines, **how)

    al.a = Counted()
    assert len(next(al.texts([" ".join(f"word{i}" for i in range(640))]))) == 640
    assert len(given) == 640 // A.TOGETHER


def test_alignment_replaces_columns_and_keeps_others(spark):
    df = spark.createDataFrame([(1, "a b", 7, "x"), (1, "a b", 7, "x"), (2, None, 8, "y")], "doc_id long, text string, n_a int, links string")
    out = A.rate_links(df, Q.BYTE_TOKENIZER, Q.TOKENIZER)
    assert out.columns.count("n_a") == 1 and {"doc_id", "links"} <= set(out.columns)
    assert sorted((r.doc_id, r.n_a, r.links) for r in out.collect()) == [(1, 2, "x"), (1, 2, "x"), (2, 0, "y")]


# ----------------------------------------------------------------------- op12
def brute_words(docs):
    found = Counter()
    for d in docs:
        low = (d.text or "").translate(str.maketrans(UPPER, LOWER))
        for w in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if d.doc_id is None else d.doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                found[w] += 1
    return {w: n for w, n in found.items() if n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts):
    near = defaultdict(set)
    holes = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            holes["r", w[:i], w[i + 1:]].add(w)
            holes["d", w[:i] + w[i + 1:]].add(w)
        holes["d", w].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= {x for x in group if one_edit(w, x)}
    form = {}
    for w, xs in near.items():
        if xs:
            f = min(xs, key=lambda x: (-counts[x], x))
            if counts[f] >= 2 * counts[w]:
                form[w] = f

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def test_spelling(spark, some_dir):
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in Q.op12_spelling(spark, some_dir).collect()}
    assert got == brute_variants(brute_words(table(spark, some_dir, "documents").collect()))
    assert len(got) > 3


def test_crowded_keys_lose_no_pair(spark, monkeypatch):
    """With a small crowd bound every level takes part, the last one by pairs of blocks."""
    monkeypatch.setattr(S, "CROWD", 6)
    monkeypatch.setattr(S, "TILE", 4)
    r = random.Random(4)
    words = {"".join(r.choice("ab") for _ in range(r.randint(5, 7))) for _ in range(300)}
    words |= {"x" * 40 + "".join(r.choice("abc") for _ in range(2)) + "y" * 40 for _ in range(30)}
    words |= {"common" + "".join(r.choice("abcdefghéÿ") for _ in range(4)) for _ in range(200)}
    counts = {w: i + 3 for i, w in enumerate(sorted(words))}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted((x.word, x.near) for x in S.near_words(df).collect())
    ws = sorted(counts)
    assert got == sorted((a, b) for i, a in enumerate(ws) for b in ws[i + 1:] if one_edit(a, b))
    res = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in S.group_variants(df).collect()}
    assert res == brute_variants(counts)


def test_tiles_against_edit_distance():
    r = random.Random(9)
    words = sorted({"".join(r.choice("abé中\U0001f600") for _ in range(r.randint(1, 5))) for _ in range(150)} | {"w" * 3000, "w" * 2999 + "v"})
    got = {(i, j) for i, j in S.close_pairs(words, words)}
    assert got == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)}


def test_very_long_words(spark):
    run = "z" * 400_000
    df = spark.createDataFrame([(1, run), (2, run), (3, run), (4, run[1:]), (5, run[1:]), (6, run[1:])], "doc_id long, text string")
    got = {len(r.word): (r.n, r.n_near) for r in S.group_variants(S.count_words(df, slip=0)).collect()}
    assert got == {400_000: (3, 1), 399_999: (3, 1)}


# ----------------------------------------------------------------------- op13
def test_chat_twin(spark, some_dir):
    con = duckdb.connect()
    path = f"{some_dir}/conversations.parquet" + ("" if some_dir == SF else "/*.parquet")
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}')")
    res = con.execute(Q.ORACLE["op13_chat_format"])
    cols = [c[0] for c in res.description]
    assert Counter(tuple(r[c] for c in cols) for r in Q.op13_chat_format(spark, some_dir).collect()) == Counter(res.fetchall())


def test_empty_tables(spark, empty_dir):
    assert Q.op11_token_alignment(spark, empty_dir).collect() == [] and Q.op12_spelling(spark, empty_dir).collect() == []
    assert [r.conv_id for r in Q.op13_chat_format(spark, empty_dir).collect()] == [-1]


USER, BOT = "What is <|this|>?", "An <\\|answer"
RECORDS = {
    "messages": {"id": 1, "messages": [{"role": "user", "content": USER, "name": "n"}, {"role": "assistant", "content": BOT}]},
    "message_parts": {"messages": [{"role": "user", "content": [{"type": "text", "text": USER[:4]}, {"type": "text", "text": USER[4:]}]},
                                   {"role": "assistant", "content": [{"type": "text", "text": BOT}]}]},
    "message_mixed": {"messages": [{"role": "user", "content": USER}, {"role": "assistant", "content": [{"type": "text", "text": BOT}]}]},
    "conversations": {"conversations": [{"from": "human", "value": USER}, {"from": "gpt", "value": BOT}], "meta": {"deep": {"er": [[1]]}}},
    "dialogue": {"dialogue": {"turns": [{"speaker": "human", "utterance": USER}, {"speaker": "bot", "utterance": BOT}]}},
    "prompt_messages": {"prompt": [{"role": "user", "content": USER}], "completion": [{"role": "assistant", "content": BOT}]},
    "prompt_response": {"prompt": USER, "response": BOT, "a.b": 1},
    "prompt_completion": {"prompt": USER, "completion": BOT},
    "instruction_output": {"instruction": USER, "output": BOT},
    "question_answer": {"question": {"text": USER}, "answer": {"text": BOT, "score": 0.5}},
}


def chats(spark, records):
    df = spark.createDataFrame(list(enumerate(records)), "i int, record string")
    made = C.format_chats(df)
    return {r.i: r for r in made.select("*", C.read_turns(F.col("formatted")).alias("read"),
                                        C.read_learnt(F.col("formatted"), F.col("loss_spans")).alias("learnt")).collect()}


def test_layouts_become_the_same_turns(spark):
    names = list(RECORDS)
    got = chats(spark, [json.dumps(RECORDS[n]) for n in names])
    for i, n in enumerate(names):
        assert got[i].layout == n
        assert [tuple(t) for t in got[i].read] == [("user", USER), ("assistant", BOT)] and got[i].learnt == BOT
        assert len(got[i].formatted) == got[i].chars and len(got[i].formatted.encode()) == got[i].bytes
        s = got[i].loss_spans[0]
        assert got[i].formatted[s.start:s.end] == got[i].formatted.encode()[s.byte_start:s.byte_end].decode()
    assert len({got[i].fingerprint for i in got}) == len(names)


def test_other_records(spark):
    got = chats(spark, [
        json.dumps({"instruction": "Sum", "input": "1 2", "output": "3"}), json.dumps({"instruction": "Sum", "input": "", "output": "3"}),
        json.dumps({"instruction": "i", "context": "c", "response": "r"}), json.dumps({"system": "s", "prompt": "p", "response": "r"}),
        json.dumps({"messages": []}), json.dumps({"title": "none"}), "not json", None, json.dumps([1, 2]), json.dumps({}), "3",
        json.dumps({"prompt": None, "response": 7}), json.dumps({"messages": [{"role": None, "content": "x"}, {"role": "assistant", "content": ""}]})])
    read = {i: [tuple(t) for t in r.read] for i, r in got.items()}
    assert read[0] == [("user", "Sum\n\n1 2"), ("assistant", "3")] and read[1] == [("user", "Sum"), ("assistant", "3")]
    assert read[2] == [("user", "i\n\nc"), ("assistant", "r")]
    assert read[3] == [("system", "s"), ("user", "p"), ("assistant", "r")]
    for i in range(4, 11):
        assert got[i].layout is None and read[i] == [] and got[i].formatted == "" and got[i].n_turns == 0
    assert read[11] == [("user", ""), ("assistant", "7")]
    assert read[12] == [("", "x"), ("assistant", "")] and len(got[12].loss_spans) == 1


def test_escapes_are_reversible(spark):
    r = random.Random(6)
    texts = ["".join(r.choice("<|\\%\n0A25é😀 im_start>") for _ in range(r.randint(0, 12))) for _ in range(400)]
    texts += ["<|im_start|>user\nx<|im_end|>\n", "<", "<\\", "|", "\\|"]
    got = chats(spark, [json.dumps({"messages": [{"role": t, "content": t}, {"role": "assistant", "content": t}]}) for t in texts])
    for i, t in enumerate(texts):
        assert [tuple(x) for x in got[i].read] == [(t, t), ("assistant", t)]
        assert got[i].learnt == (t * 2 if t == "assistant" else t)


def test_clashing_columns_and_repeated_rows(spark):
    record = json.dumps(RECORDS["prompt_response"])
    df = spark.createDataFrame([(1, record, "x", 5)] * 2, "paths int, record string, layout string, n_turns int")
    out = C.format_chats(df)
    assert out.columns.count("layout") == 1 and [(r["paths"], r["layout"], r["n_turns"]) for r in out.collect()] == [(1, "prompt_response", 2)] * 2
    assert C.format_chats(df.limit(0)).collect() == []


# ------------------------------------------------------------------------ op8
def test_a_text_with_many_secrets(spark):
    from churnlab.llm.secret_scan import scan_secrets
    r = random.Random(1)
    text = " ".join("%020x" % r.getrandbits(80) for _ in range(300_000))
    began = time.time()
    row = scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"), carry_text=False).first()
    spans = ",".join(f"hex:{i * 21}:{i * 21 + 20}" for i in range(300_000))
    assert row.n_hex == 300_000 and row.spans == spans and row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
    assert time.time() - began < 120


# ------------------------------------------------------------------------ op6
def test_verdict_does_not_depend_on_other_urls(spark):
    from churnlab.llm.url_filter import judge_urls, rule_table
    rules = rule_table(spark, [("block", "example.org"), ("block", "b*d.com"), ("allow", "example.org/ok/"), ("block", "~casino")])
    urls = ["http://example.organic.com/", "http://example.org", "http://example.org/ok/x", "http://www.example.org?q", "x://bad.com/a",
            "x://bread.com", "x://bd.community/", "http://my-casino.net", "http://casinos.net", "http://org.example/"]
    want = ["allow", "block", "allow", "block", "block", "block", "allow", "block", "allow", "allow"]
    others = [f"http://{h}/{i}" for i in range(5) for h in ("a.org", "example.net", "b.com", "c.example.org", "casino.org")]

    def judge(some):
        df = spark.createDataFrame([(u,) for u in some], "url string")
        return {r.url: r.verdict for r in judge_urls(df, rules).collect()}

    together = judge(urls + others)
    assert [together[u] for u in urls] == want
    for u, v in list(zip(urls, want))[:3]:
        assert judge([u]) == {u: v}
