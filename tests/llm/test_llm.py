"""Every operator against a plain or brute-force version, and its defined results for odd rows."""

import hashlib
import html as html_lib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NOISE = "the and of to in that thing other idea order tender enter ring".split()


def make_text(rs, n, words=None):
    words = words or [a + b for a in NOISE for b in NOISE[:6]]
    return " ".join(rs.choice(words) for _ in range(n))


def odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and ids, and an extra column with a clashing name."""
    rs = np.random.RandomState(0)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (4, "One two", "en", "a", 7),
        (5, "x" * 3000 + " " + make_text(rs, 30_000), "en", "b", 9),
        (6, "tie tie tie", "de", "b", 11),
        (6, "tie tie tie", "de", "b", 11),
        (None, "no id here at all but words", "de", None, 3),
        (7, "Ünï cödé\u00a0text\x0bwith <|endoftext|> & <b>marks</b>", "fr", "c", 3),
    ]
    return spark.createDataFrame(rows, DOC).withColumn("score", F.lit("clash")).withColumn("size", F.lit(None).cast("int")).withColumn("label", F.lit(3))


# ------------------------------------------------------------------ 1 HTML


def page(body, nav="", foot="f"):
    return f"<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a href='/x'>{nav}</a></nav>{body}<footer>{foot}</footer></body></html>"


def test_html_text_of_template_pages(spark):
    from quillgraph.llm.html_text import extract

    rows, want = [], {}
    for i in range(14):
        paragraphs = [f"Text {i} &amp; more words {j}   here\n and there {i * j}." for j in range(1, 4)]
        inner = "".join(f"<p>{p}</p>" for p in paragraphs)
        body = f'<div class="content-{i}"><div class="sidebar">Side {i}</div><div id="story"><h1>Head {i}</h1>{inner}<p>Read this every day</p></div><form>Name <input></form><div class="comments"><p>Reader {i}</p></div></div>'
        rows.append((i, f"http://h.org/{i}", page(body, f"menu {i}", f"foot {i}")))
        want[i] = "\n".join([f"Head {i}"] + [" ".join(html_lib.unescape(p).split()) for p in paragraphs])
    rows += [(20, None, None), (21, "x", ""), (22, "http://one.org/", page("<article><h1>A</h1><p>b<br>c<p>d <b>e</article>")), (22, "http://one.org/", page("<article><h1>A</h1><p>b<br>c<p>d <b>e</article>")), (23, "http://two.org", "plain &lt;text&gt; only")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("text", F.lit(1))
    got = extract(df).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    for i, t in want.items():
        assert text[i] == t
    assert text[20] == text[21] == "" and text[22] == "A\nb c\nd e" and text[23] == "plain <text> only"
    assert extract(df.limit(0)).count() == 0


def test_html_text_of_the_generated_pages(spark):
    from quillgraph.llm.html_text import op1_html_text

    source = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for r in op1_html_text(spark, "/root/testdata/sf0.001").collect():
        article = re.search(r"<article>(.*)</article>", source[r.page_id], re.S).group(1)
        blocks = [" ".join(html_lib.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b)


def test_html_template_needs_valid_classes(spark):
    from quillgraph.llm.html_text import extract

    # The inner element is in 18 of 20 pages with a vector that no other token has: data of the wrapper's slot, not a template
    rows, want = [], {}
    for i in range(20):
        long, short = f"Long words of page {i} and more" + " words" * 40, f"Closing words of page {i}"
        inner = f"<p>{long}</p>" * (1 + i % 3)
        rows.append((i, f"http://c.org/{i}", page(f'<div class="wrap"><div class="{"text" if i % 10 else "plain"}">{inner}</div><p>{short}</p></div>')))
        want[i] = "\n".join([long] * (1 + i % 3) + [short])
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want


def test_html_fixed_text_by_share_of_pages(spark):
    from quillgraph.llm.html_text import extract

    # Null and empty pages, one without the notice, one that repeats it, one laid out differently; and a host of nine pages
    notice = "<p>All rights are with the house</p>"
    rows = [(i, f"http://f.org/{i}", page(f"<article><h1>Head {i}</h1><p>Text {i}</p>{notice * ((i != 3) + (i == 4))}</article>")) for i in range(12)]
    rows += [(12, "http://f.org/n", None), (13, "http://f.org/e", ""), (14, "http://f.org/x", page("<div><p>Error 14</p></div>"))]
    rows += [(i, f"http://g.org/{i}", page(f"<article><h1>Head {i}</h1><p>Text {i}</p>{notice}</article>")) for i in range(20, 29)]
    text = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(text[i] == f"Head {i}\nText {i}" for i in (*range(12), *range(20, 29)))
    assert text[12] == text[13] == "" and text[14] == "Error 14"


def extracted(spark, rows, **k):
    from quillgraph.llm.html_text import extract

    return {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string"), **k).collect()}


def test_html_shared_sentences_are_kept(spark):
    # An opening sentence that all articles of a host share, with and without a heading, and one in between
    rows, want = [], {}
    for i in range(12):
        head = f"<h1>Head {i}</h1>" if i % 2 else ""
        rows.append((i, f"http://s.org/{i}", page(f"<article>{head}<p>The house says so.</p><p>Own words {i}</p><p>As ever.</p><p>Last words {i}</p></article>")))
        want[i] = ([f"Head {i}"] if i % 2 else []) + ["The house says so.", f"Own words {i}", "As ever.", f"Last words {i}"]
    assert extracted(spark, rows) == {i: "\n".join(w) for i, w in want.items()}


def test_html_class_names_inside_an_article(spark):
    inner = '<h1>T</h1><div class="social-science"><p>Science</p></div><div class="cookie-recipe"><p>Recipe</p></div><div class="share-buttons">Share</div><div class="comments"><p>Reader</p></div><aside>Side</aside>'
    assert extracted(spark, [(1, "http://n.org/1", page(f"<article>{inner}</article>"))]) == {1: "T\nScience\nRecipe"}


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_html_boxes_without_a_name(spark, broadcast):
    # A box that differs in digits only, at any place of the article; and boxes told apart by digits of their names
    rows, want = [], {}
    for i in range(12):
        box = f'<div class="x7">Try our app for {i} days</div>'
        body = f"<h1>Head {i}</h1>{box}<p>Some {'words ' * 9}of page {i}</p><div class='x{i}'><p>Part one {i} {'abcdefghijkl'[i]}</p></div><p>End {i}</p>"
        rows.append((i, f"http://b.org/{i}", page(f"<article>{body}</article>")))
        want[i] = f"Head {i}\nSome {'words ' * 9}of page {i}\nPart one {i} {'abcdefghijkl'[i]}\nEnd {i}"
    assert extracted(spark, rows, max_broadcast_tokens=broadcast) == want
    # Pages that all stand twice have the same classes
    assert extracted(spark, rows * 2, max_broadcast_tokens=broadcast) == want


def test_html_classes_against_plain_vectors(spark, monkeypatch):
    from quillgraph.llm import html_text as h
    from quillgraph.llm.common import Scratch

    rs = np.random.RandomState(20)
    rows = []
    for i in range(30):
        parts = [f"<div class='{c}'>{'<p>' * n}text {rs.randint(9)}</div>" for c, n in zip("abcde", rs.randint(0, 3, 5), strict=True) if rs.rand() < 0.8]
        rs.shuffle(parts)
        rows.append((int(rs.randint(1000)), "http://v.org/", page(f"<main><section>{''.join(parts)}</section></main>", f"menu {i}")))
    rows += rows[:5]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("v.org"))
    tokens = [t.asDict() for t in h.deduce(df, Scratch(spark)).first().tokens]
    got = h.template_of(tokens)
    # Plain: a vector of counts over all pages for each element
    vectors, parent, tag = defaultdict(lambda: [0] * len(rows)), {}, {}
    for k, (_, _, source) in enumerate(rows):
        _, counts, parents, _ = h.parse(source)
        for t, n in counts.items():
            vectors[t][k] = n
            parent[t], tag[t] = parents[t]
    sizes = Counter(map(tuple, vectors.values()))
    valid = {t for t, v in vectors.items() if 2 * sum(map(bool, v)) >= len(rows) and (sizes[tuple(v)] > 1 or tag[t] in h.MAIN_TAGS)}
    template = set()
    while more := {t for t in valid - template if parent[t] == 0 or parent[t] in template}:
        template |= more
    assert got[1] == template and tag[got[0]] in ("section", "main")
    assert 0 < len(valid) < len(vectors)
    # Without the vectors the template is another
    assert h.template_of([{**t, "low": 0, "high": 0} for t in tokens])[1] != template


def test_html_long_pages_and_ties(spark):
    long = "word " * 300_000
    rows = [(1, "http://l.org/", page(f"<article><p>{long}</article>")), (2, None, "<div><p>one</p></div><div><p>two</p></div>"), (2, None, "<div><p>one</p></div><div><p>two</p></div>")]
    assert extracted(spark, rows) == {1: long.strip(), 2: "one\ntwo"}


# ------------------------------------------------------------------ 2 mixing


def water_fill(sizes):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, fixed, left = dict.fromkeys(order, 0.0), set(), float(sum(sizes.values()))
    while True:
        open_ = [s for s in order if s not in fixed]
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w > 3 * sizes[s]]
        if not over:
            for s in open_:
                target[s] = left * weight[s] / w
            return target
        for s in over:
            target[s] = 3.0 * sizes[s]
            fixed.add(s)
            left -= target[s]


def test_mixing_meets_targets(spark):
    from quillgraph.llm.mixing import mix

    rs = np.random.RandomState(1)
    rows = [(i, make_text(rs, int(rs.randint(0, 60))), "en", [None, "a", "b", "c", "d", "é"][min(5, i % 9)] if i % 3 else "a", 1) for i in range(900)]
    df = spark.createDataFrame(rows, DOC)
    got = mix(df).collect()
    size = {r[0]: len(WORD.findall(r[1])) for r in rows}
    by = Counter()
    for r in rows:
        by[r[3]] += size[r[0]]
    target, taken = water_fill(by), Counter()
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r.doc_id]
        assert r["size"] == size[r.doc_id] and r.source_size == by[s] and abs(r.target - target[s]) < 1e-6 * target[s] + 1e-9
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for s in by:
        assert abs(taken[s] - target[s]) <= 1
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(df.repartition(7)).collect()), key=str)
    whole = mix(df, cut_last=False).collect()
    assert all(r.taken % max(1, r["size"]) == 0 for r in whole)


def test_mixing_of_small_sources_meets_targets_to_a_word(spark):
    import duckdb

    from quillgraph.llm.mixing import OP2_SQL, mix

    rs = np.random.RandomState(2)
    # Targets that round up to a whole copy, and others of few words; then a case with 9.67 words wanted of 10
    for case in range(6):
        sizes = [10, 19] if not case else rs.randint(0, 30, rs.randint(1, 9)).tolist()
        rows = [(i, "w", "en", f"s{s}", 1) for s, n in enumerate(sizes) for i in range(s * 100, s * 100 + max(n, 1))]
        rows = [(i, t if sizes[int(s[1:])] else "", la, s, c) for i, t, la, s, c in rows]
        df = spark.createDataFrame(rows, DOC)
        got = mix(df).collect()
        source, taken, target = {r[0]: r[3] for r in rows}, Counter(), {}
        for r in got:
            taken[source[r.doc_id]] += r.taken
            target[source[r.doc_id]] = r.target
        want = water_fill({f"s{s}": n for s, n in enumerate(sizes)}) if sum(sizes) else dict.fromkeys(target, 0.0)
        assert all(abs(target[s] - want[s]) < 1e-9 and abs(taken[s] - want[s]) <= 0.5 + 1e-9 for s in target)
        documents = df.toPandas()  # noqa: F841  read by the SQL
        oracle = {r[0]: r[1:] for r in duckdb.sql(OP2_SQL).fetchall()}
        assert all((r["size"], r.source_size, r.target, r.taken) == oracle[r.doc_id][:4] for r in got)


def test_mixing_prefers_longer_documents_mildly_and_takes_fixed_sizes(spark):
    from quillgraph.llm.mixing import mix

    rows = [(i, "w " * (5 if i % 2 else 50), "en", "a" if i < 2000 else "b", 1) for i in range(4000)]
    got = [r for r in mix(spark.createDataFrame(rows, DOC), weights=(1, 3)).collect() if r.doc_id < 2000]
    share = [np.mean([r.share > 0 for r in got if r["size"] == n]) for n in (5, 50)]
    assert 0.3 < share[0] < share[1] < 0.7


def test_mixing_odd_rows(spark):
    from quillgraph.llm.mixing import mix

    df = odd_rows(spark)
    got = mix(df).collect()
    assert len(got) == df.count() and all(r.taken == 0 for r in got if r["size"] == 0)
    assert mix(df.limit(0)).count() == 0
    empty = mix(df.where("doc_id < 4")).collect()
    assert {(r.target, r.taken) for r in empty} == {(0.0, 0)}


# ------------------------------------------------------------------ 3 BPE


def test_bpe_equals_the_tokenizers_library(spark):
    from tokenizers import Tokenizer

    from quillgraph.llm.bpe import encode, production_vocabulary

    own = Tokenizer.from_file(production_vocabulary())
    rs = np.random.RandomState(2)
    signs = list("etaoin  \n\t'sré€中0123.,!-=<|>") + ["<|endoftext|>", "   ", "'ll", "\u00a0", "\x85", "👍"]
    rows = [(i, "".join(rs.choice(signs) for _ in range(int(rs.randint(0, 200)))), "", "", 0) for i in range(300)]
    df = spark.createDataFrame(rows, DOC).unionByName(odd_rows(spark).select(*[c.split()[0] for c in DOC.split(", ")]))
    want = []
    for r in df.collect():
        ids = own.encode(r.text or "", add_special_tokens=False).ids
        text = own.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, encode(df, production_vocabulary()).collect()), key=str) == sorted(want, key=str)
    assert encode(df.limit(0), production_vocabulary()).count() == 0
    few = encode(df.limit(5), production_vocabulary(), ids=True).collect()
    assert all(len(r.ids) == r.n_tokens for r in few)


# ------------------------------------------------------------------ 4 toxicity


def test_viterbi_restores_disguised_words():
    from quillgraph.llm.toxicity import CharModel, Restorer

    counts = Counter()
    for word, n in (("idiot", 50), ("moron", 50), ("trash", 50), ("stupid", 50), ("other", 80), ("thing", 80), ("letter", 80), ("hello", 80)):
        s = [32, 32, *word.encode(), 32]
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            counts[a << 16 | b << 8 | c] += n
    r = Restorer(CharModel(dict(counts)))
    for raw, want in ((b"1d10t", b"idiot"), (b"m0r0n!", b"moron"), (b"tra5h", b"trash"), (b"$tupid", b"stupid"), (b"idiooooot", b"idiot"), (b"i d i o t", b"idiot"), (b"m.o.r.o.n", b"moron")):
        assert r.token(raw) == want
    for clean in (b"hello", b"letter,", b"123", b"..."):
        assert r.token(clean) is None


def every_reading(token, lm):
    """All texts that a token may stand for, with the score of the best way to each."""
    from quillgraph.llm import toxicity as t

    best = {}

    def go(at, a, b, text, score):
        if at == len(token):
            score += lm.logp(a, b, 32)
            best[text] = max(score, best.get(text, -1e300))
            return
        for c, cost in t.emitted(token[at]):
            if c < 0:
                go(at + 1, a, b, text, score + cost)
                continue
            go(at + 1, b, c, text + bytes([c]), score + cost + lm.logp(a, b, c))
            if c == b:
                go(at + 1, a, b, text, score + t._REPEAT)

    go(0, 32, 32, b"", 0.0)
    return best


def test_viterbi_against_every_reading():
    from quillgraph.llm.toxicity import CharModel, viterbi

    rs = np.random.RandomState(16)
    corpus = " ".join(rs.choice("idiot toxic stupid small letters test tall silly".split(), 300)).encode()
    lm = CharModel(Counter(a << 16 | b << 8 | c for a, b, c in zip(b"  " + corpus, b" " + corpus, corpus, strict=False)))
    for _ in range(150):
        token = bytes(rs.choice(list(b"istolde1450!@| .-*"), rs.randint(1, 7)).tolist())
        best = every_reading(token, lm)
        top = max(best.values())
        for settle in (1, 3, 512):
            got = viterbi(token, lm, settle)
            assert any(abs(s - top) < 1e-9 for x, s in best.items() if x.strip() == got), (token, got)


def test_viterbi_of_long_tokens_takes_little_memory():
    import tracemalloc

    from quillgraph.llm.toxicity import CharModel, Restorer, viterbi

    lm = CharModel(Counter({32 << 16 | 32 << 8 | 97: 5, 32 << 16 | 97 << 8 | 98: 5}))
    token = b"a.b " * 15_000
    whole = viterbi(token, lm, settle=10**9)
    tracemalloc.start()
    assert viterbi(token, lm) == whole
    assert tracemalloc.get_traced_memory()[1] < 2_000_000
    tracemalloc.stop()
    # A long token that is mostly signs is decoded as well
    assert Restorer(lm).token(b"4" * 20 + b"b") is not None


def test_toxicity_on_held_out_documents(spark):
    from quillgraph.llm.toxicity import toxicity

    rs = np.random.RandomState(3)
    bad = "idiot moron trash stupid clown".split()
    disguise = [lambda w: w, lambda w: w.replace("i", "1").replace("o", "0"), lambda w: " ".join(w), lambda w: w.replace("o", "ooo").replace("a", "aaa")]
    docs, labels = [], []
    for i in range(700):
        words = make_text(rs, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words.insert(int(rs.randint(0, 60)), disguise[int(rs.randint(0, 4)) if i % 3 == 0 else 0](str(rs.choice(bad))))
        docs.append((i, " ".join(words), "", "", 0))
        labels.append((i, int(toxic)))
    labels += [(3, None), (9999, 1), (None, 1)]
    got = toxicity(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == 700
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out]
    right = np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held])
    assert right > 0.97 and not any(r.predicted for r in held if r.doc_id % 4)


def test_toxicity_odd_rows(spark):
    from quillgraph.llm.toxicity import toxicity

    df = odd_rows(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity(df, none).count() == df.count()
    one = spark.createDataFrame([(1, 0), (2, 0), (4, 0)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity(df, one).collect()} == {0}
    assert toxicity(df.limit(0), one).count() == 0


# ------------------------------------------------------------------ 5 quality rules


def plain_rules(text):
    text = text or ""
    words = WORD.findall(text)
    where = defaultdict(list)
    for i in range(len(words) - 4):
        where[tuple(words[i : i + 5])].append(i)
    covered = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    longest = 0
    for at in where.values():
        for x in range(len(at)):
            for y in range(x + 1, len(at)):
                n = 0
                while at[y] + n < len(words) and words[at[x] + n] == words[at[y] + n]:
                    n += 1
                longest = max(longest, n)
    twenty = defaultdict(list)
    for i in range(len(words) - 19):
        twenty[tuple(words[i : i + 20])].append(i)
    long = len({j for at in twenty.values() if len(at) > 1 for i in at for j in range(i, i + 20)})
    kept = not failed and longest <= 100 and 100 * long <= 10 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed, kept, longest, long)


def test_quality_rules_against_plain_version(spark):
    from quillgraph.llm.quality_rules import apply_rules

    rs = np.random.RandomState(4)
    texts = [None, "", " \n", "a", "a a a a a a a a a a a a a", "ab cd ab cd ab cd\nab cd\nab cd\n\n ab cd\r"]
    for _ in range(120):
        w = [str(x) for x in rs.randint(0, rs.choice([2, 8, 400]), int(rs.randint(1, 160)))]
        at, n = int(rs.randint(0, len(w))), int(rs.randint(0, 40))
        w[at:at] = w[:n] if rs.rand() < 0.5 else []
        texts.append("".join(x + rs.choice([" ", "\n", "\t", " # ", "é "]) for x in w))
    passage = make_text(rs, 105, [f"p{i}" for i in range(5000)])
    texts.append(passage + " " + make_text(rs, 2000, [f"q{i}" for i in range(90_000)]) + " " + passage)
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], DOC)
    got = {r.doc_id: tuple(r)[1:] for r in apply_rules(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_rules(t), (i, t)
    assert got[len(texts) - 1][5:7] == (False, False)  # only the suffix-array rule rejects it


def test_each_quality_limit_decides_for_itself(spark):
    from quillgraph.llm.quality_rules import apply_rules

    fresh = iter(f"q{i}" for i in range(10**6))
    words = lambda n: [next(fresh) for _ in range(n)]
    phrases = [words(6) for _ in range(8)]
    cases = {
        "clean": (words(400), True),
        "base": (words(50) * 2, False),
        "covered": ((p := words(30)) + words(190) + p + words(190), False),  # 60 of 440 words in repeats of 30
        "at the limit": ((p := words(20)) + words(180) + p + words(180), True),  # 40 of 400 words
        "short repeats": ([w for p in phrases for w in p + words(20)] + [w for p in phrases for w in p + words(20)] + words(80), True),  # 96 of 496 words, none of 20
        "longest": ((p := words(105)) + words(1000) + p + words(1000), False),  # 9.5 % of the words
    }
    df = spark.createDataFrame([(i, " ".join(w), k, "", 0) for i, (k, (w, _)) in enumerate(cases.items())], DOC)
    got = {r.doc_id: r for r in apply_rules(df).collect()}
    for i, (k, (w, kept)) in enumerate(cases.items()):
        assert got[i].kept == kept == plain_verdict(w), k
        assert got[i].base_failed == (k == "base")
    assert got[2].n_long_words == 60 and got[3].n_long_words == 40 and got[4].n_long_words == 0
    # A very long text
    long = spark.createDataFrame([(1, " ".join(words(300_000)), "", "", 0)], DOC)
    assert apply_rules(long).first().kept


def plain_verdict(w, max_longest=100, long_words=20, max_long_covered=0.1):
    """Whether words pass the base and the limits on repeats, by dictionaries of windows."""

    def covered(n):
        at = defaultdict(list)
        for i in range(len(w) - n + 1):
            at[tuple(w[i : i + n])].append(i)
        return len({j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + n)})

    if len(w) < 10 or 100 * covered(5) > 20 * len(w):
        return False
    return covered(max_longest + 1) == 0 and covered(long_words) <= max_long_covered * len(w)


def test_maximal_spans_and_odd_rows(spark):
    from quillgraph.llm.quality_rules import apply_rules

    df = spark.createDataFrame([(1, "a b c d e f x a b c d e f y", "", "", 0)], DOC)
    r = apply_rules(df, spans=True, min_words=5).first()
    assert [(s.start, s.end) for s in r.repeats] == [(0, 6), (7, 13)] and r.longest_repeat == 6
    odd = odd_rows(spark)
    assert apply_rules(odd).count() == odd.count() and apply_rules(odd.limit(0)).count() == 0
    assert apply_rules(odd, carry=True).columns == [*odd.columns, "kept"]


# ------------------------------------------------------------------ 6 nearest neighbours


def exact_neighbours(ids, x, q, k=5):
    s = (x @ x[q]) / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[q]))
    ok = ids != ids[q]
    order = np.lexsort((ids[ok], -np.round(s[ok], 12)))[:k]
    return ids[ok][order], s[ok][order]


def test_neighbours_are_exact_where_full_recall_is_asked(spark):
    from quillgraph.llm.neighbours import nearest

    rs = np.random.RandomState(5)
    x = rs.randn(230, 8)
    x[100:130] = x[100]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(300, None), (350, [0.0] * 8), (400, [float("nan")] * 8), (450, [1.0] * 7 + [None]), (500, [1.0, 2.0]), (None, [1.0] * 8), (550, [float("inf")] * 8)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("part", F.lit("clash"))
    got, how = defaultdict(list), {}
    for r in nearest(df, recall=1.0, explain=how).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [0, 50, 100, 150, 200]
    for q, found in got.items():
        ids, s = exact_neighbours(np.arange(230), x, q)
        assert [f[1] for f in found] == ids.tolist() and [f[0] for f in found] == [1, 2, 3, 4, 5]
        assert np.allclose([f[2] for f in found], s, atol=1e-12)
    assert how["parts"] == 8  # the table is small, but goes the same way
    assert nearest(df.limit(0)).count() == 0
    assert [r["count"] for r in nearest(df.where("vec_id < 12")).groupBy("query_id").count().collect()] == [5]
    assert nearest(df.where("vec_id < 3")).count() == 2
    assert nearest(df.where("vec_id IN (0, 1)").unionByName(df.where("vec_id IN (0, 1)"))).count() == 1


def test_neighbours_by_learned_partitions_reach_recall(spark):
    from quillgraph.llm.neighbours import nearest

    rs = np.random.RandomState(6)
    centres = rs.randn(40, 16)
    x = centres[rs.randint(0, 40, 4000)] + 0.4 * rs.randn(4000, 16)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    how = {}
    for r in nearest(df, sample_per_part=40, explain=how).collect():
        got[r.query_id].add(r.vec_id)
    hits = sum(len(got[q] & set(exact_neighbours(np.arange(4000), x, q)[0].tolist())) for q in range(0, 4000, 50))
    assert hits / 400 >= 0.9
    assert how["parts"] == 32 and how["routes"] <= 8 and how["largest"] <= 2.5 * how["mean"]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_neighbours_query_against_brute_force(spark, sf):
    from quillgraph.llm.neighbours import op6_neighbours

    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = defaultdict(list)
    for r in op6_neighbours(spark, f"/root/testdata/{sf}").orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    queries = ids[ids % 50 == 0].tolist()
    assert sorted(got) == sorted(queries) and all(len(v) == 5 for v in got.values())
    hits = sum(len(set(got[q]) & set(exact_neighbours(ids, x, q)[0].tolist())) for q in queries)
    assert hits >= 0.9 * 5 * len(queries)


# ------------------------------------------------------------------ 7 chat


def test_chat_rotates_perspectives(spark):
    from quillgraph.llm.chat import rotate

    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 3, None, "?"), (2, 0, "system", "alone"), (None, 0, "ann", "x"), (1, 1, "ann", "hi <|im_end|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("name", F.lit("clash"))
    got = rotate(df).orderBy("conv_id", "perspective", "turn").collect()
    assert len(got) == 5 * 3 + 1 and {r.conv_id for r in got} == {1, None}
    own = [r for r in got if r.perspective == "ann" and r.conv_id == 1]
    assert [r.chat_role for r in own] == ["system", "assistant", "assistant", "user", "user"] and [r.name for r in own] == [None, None, None, "bob", "unknown"]
    for r in got:
        assert (r.learn_to > 0) == (r.chat_role == "assistant")
        if r.learn_to:
            assert r.rendered[r.learn_from : r.learn_to].endswith("<|im_end|>") and r.rendered.count("<|im_start|>") == 1
    assert rotate(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 8 near duplicates


def plain_components(texts):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in texts}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    ids = sorted(texts)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= 85 * (len(sets[x]) + len(sets[y]) - both):
                    a, b = find(x), find(y)
                    up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    from quillgraph.llm import near_dup

    monkeypatch.setattr(near_dup, "BLOCK", 16)  # groups of several blocks
    rs = np.random.RandomState(7)
    words = [f"w{i}" for i in range(3000)]
    texts = {0: None, 1: "", 2: "One TWO", 3: "one two", 4: " \n"}
    base = make_text(rs, 120, words).split()
    for i in range(5, 130):  # one large group: chains of small changes, and copies
        base = list(base)
        for _ in range(int(rs.randint(0, 3))):
            base[int(rs.randint(0, 120))] = str(rs.choice(words))
        texts[i] = " ".join(base)
    for i in range(130, 260):
        texts[i] = make_text(rs, int(rs.randint(3, 90)), words)
    for i in range(260, 300):
        w = texts[int(rs.randint(130, 260))].split()
        w[int(rs.randint(0, len(w)))] = "changed"
        texts[i] = " ".join(w).upper() if i % 2 else " ".join(w)
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in texts.items()], DOC)
    want = plain_components(texts)
    got = near_dup.near_duplicates(df).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_odd_rows(spark):
    from quillgraph.llm.near_dup import near_duplicates

    df = odd_rows(spark)
    got = near_duplicates(df).collect()
    assert len(got) == df.count() and all(r.kept for r in got)
    assert near_duplicates(df.limit(0)).count() == 0


def test_estimate_is_near_the_similarity():
    from quillgraph.llm.near_dup import estimate, signatures

    rs = np.random.RandomState(8)
    a = rs.randint(0, 1 << 62, 1000).astype(np.uint64)
    for share in (0.5, 0.85, 1.0):
        n = int(2000 * share / (1 + share))
        b = np.concatenate([a[:n], rs.randint(0, 1 << 62, 1000 - n).astype(np.uint64)])
        s = signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]))["sig"]
        assert abs(estimate(s[0], s[1]) - share) < 0.12


def test_components(spark):
    from quillgraph.llm.common import Scratch
    from quillgraph.llm.graph import components

    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 5), (5, 9), (9, 7), (3, 3), (200, 1), (201, 1), (202, 201)]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark)).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in (5, 7, 9)} == {5} and {got[i] for i in (1, 200, 201, 202)} == {1}


# ------------------------------------------------------------------ 9 URLs


@pytest.mark.parametrize(
    "url, host, path, rule",
    [
        ("http://A.B.org/x?y", "a.b.org", "/x", "org/"),
        ("http://m.example.org/es/1", "m.example.org", "/es/1", "example.org/es/"),
        ("http://example.org/en/12#f", "example.org", "/en/12", "example.org/en/1"),
        ("http://badexample.org/es/1", "badexample.org", "/es/1", "org/"),
        ("https://x.com/fr/", "x.com", "/fr/", "com/fr/"),
        ("https://x.com/de", "x.com", "/de", None),
        ("https://x.org", "x.org", "", None),
        ("https://x.org?a=/b", "x.org", "", None),
        ("x.org/es/", "", "", None),
        (None, "", "", None),
        ("", "", "", None),
        ("a://b://c.org/", "b:", "//c.org/", None),
    ],
)
def test_url_parts_and_rules(spark, url, host, path, rule):
    from quillgraph.llm.urls import judge

    r = judge(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert (r.host, r.path, r.rule) == (host, path, rule)
    assert r.verdict == ({"org/": "allow", "com/fr/": "allow"}.get(rule, "block") if rule else "allow")


def test_url_trees_learn(spark):
    from quillgraph.llm.urls import judge

    rs = np.random.RandomState(9)
    rows = []
    for i in range(1500):
        spam = i % 2
        tail = "".join(str(rs.randint(0, 10)) for _ in range(20)) + "?a=1&b=2&c=3" if spam else "about/us"
        zone = "com" if i < 1000 else "net"
        rows.append((i, f"http://h{rs.randint(0, 30)}.{zone}/{'de' if spam else 'fr'}/{tail}" if zone == "com" else f"http://h{rs.randint(0, 30)}.{zone}/xx/{tail}"))
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(5))
    got = [r for r in judge(df).collect() if r.page_id >= 1000]
    assert np.mean([(r.verdict == "block") == bool(r.page_id % 2) for r in got]) > 0.95
    assert judge(df.limit(0)).count() == 0


def test_url_query_runs_no_python(spark):
    from quillgraph.llm.urls import op9_url_filters

    plan = op9_url_filters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ------------------------------------------------------------------ 10 language model


def test_lm_base_counts_and_model(spark):
    from quillgraph.llm.lm import score

    rs = np.random.RandomState(10)
    p = 1 / np.arange(1, 401)
    words = ["".join(rs.choice(list("aeioulnrst")) for _ in range(rs.randint(2, 9))) for _ in range(400)]
    rows = [(i, " ".join(rs.choice(words, 60, p=p / p.sum())), "en" if i % 2 else "fr", "", 0) for i in range(400)]
    rows += [(1000, None, None, None, 0), (1001, "", "en", "", 0), (1001, "", "en", "", 0), (1002, "\x00 NUL \x00", "en", "", 0), (1003, "z" * 5000, "en", "", 0), (None, "no id", "en", "", 0)]
    got = score(spark.createDataFrame(rows, DOC).withColumn("h", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = lambda t: WORD.findall((t or "").lower()) + ["\n"]
    c = Counter(w for i, t, *_ in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        w = tokens(text[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
        assert -math.inf < r.score < 0 and 0 < r.bits_per_byte < 100
    out = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    # Words are drawn one by one from few, so the base knows their distribution and contexts can't help
    assert sum(r.score for r in out) > 1.02 * sum(r.base_score for r in out)


def test_lm_is_well_above_the_base_and_hears_the_order_of_words(spark):
    from quillgraph.llm.lm import score

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 1]
    train = docs.where(~F.col("doc_id").isin([r.doc_id for r in held]))

    def per_token(texts):
        probes = spark.createDataFrame([(r.doc_id, t, "en", "", 0) for r, t in zip(held, texts, strict=True)], DOC)
        got = [r for r in score(train.unionByName(probes)).collect() if r.held_out]
        n = sum(r.n_tokens for r in got)
        return sum(r.score for r in got) / n, sum(r.base_score for r in got) / n, {r.doc_id: r.score for r in got}

    own, base, _ = per_token([r.text for r in held])
    assert own > base + 0.2
    rs = np.random.RandomState(14)
    shuffled, _, _ = per_token([" ".join(rs.permutation(WORD.findall(r.text))) for r in held])
    assert own > shuffled + 0.2


def plain_price(coder, words, own):
    """One text word by word: leaf and 64-bit hash of each token; own: whether its counts are in the tables."""
    from quillgraph.llm import lm_context as c
    from quillgraph.llm.common import _R, mix

    one = lambda x: int(mix(np.array([x & (2**64 - 1)], np.uint64))[0])
    w, v, apm = coder.weights.w.copy(), np.full(c.GATES, c.CALM), coder.weights.apm.copy()
    bits = len(coder.table).bit_length() - 1
    like, last, came, out, waiting = np.zeros(coder.like.shape[1]), {}, [0, 0, 0], [], []
    for t, (leaf, h) in enumerate(words):
        if t in (32, 64, 128, 256, 512) or (t and t % 1024 == 0):
            grad, square, cell_n, cell_1 = defaultdict(float), defaultdict(float), Counter(), Counter()
            for bit, s, gates, inputs, cell in waiting:
                for g, x in zip(gates, inputs, strict=True):
                    grad[g] += x * (bit - s)
                    square[g] += (x * (bit - s)) ** 2
                cell_n[cell] += 1
                cell_1[cell] += bit
            for g in grad:
                v[g] += square[g]
                w[g] += 4 * c.RATE * grad[g] / math.sqrt(v[g])
            for k, n in cell_n.items():
                apm[k] = apm[k] * c.KEEP**n + cell_1[k] / n * (1 - c.KEEP**n)
            waiting = []
        z = int(np.argmax(like))
        back = [words[t - j][1] if t >= j else 0 for j in range(1, 6)]
        two, single = one(back[0] * _R + back[1] + int(c._SALT[0])), one(back[0] + int(c._SALT[1]))
        wants, sure, hits = [], [], []
        for ctx in (two, single):
            got = int(coder.table[ctx >> (64 - bits)])
            level, share, want = got >> 20 & 7, got >> 18 & 3, got & (2**18 - 1)
            if not level or got >> 23 != ctx >> (64 - bits - 9) & 511:
                want = -1
            hits.append(want == leaf)
            if want == leaf and own and level <= 3:
                level -= 1
            wants.append(want if level else -1)
            sure.append(min(1 + level, 5) if share == 2 else share)
        at = last.get(two, -1) if t else -1
        longer = 0
        if at >= 0:
            longer = 1
            while longer < 4 and back[longer + 1] and at >= longer + 2 and words[at - longer - 2][1] == back[longer + 1]:
                longer += 1
        wants.append(words[at][0] if at >= 0 else -1)
        hits.append(at >= 0 and words[at][0] == leaf)
        sure.append(longer)
        last[two] = t
        sure = [2 * s + f for s, f in zip(sure, came, strict=True)]
        came = [int(x) for x in hits]
        total, failed, tried = 0.0, 0.0, []
        for k in c.ORDER:
            if wants[k] < 0 or wants[k] in tried:
                continue
            tried.append(wants[k])
            p0 = min(10.0 ** float(coder.leaf_price[z, wants[k]]), 0.999)
            side = [0 if x < 0 else (1 if x == wants[k] else -1) for x in wants]
            speak = sum((x + 1) * 3**e for e, x in enumerate(side))
            gates = [speak, *[c.SETS + (e * c.SURE + sure[e]) * c.SETS + speak for e in range(3)]]
            inputs = [math.log(p0 / (1 - p0)), *side]
            y = min(11.0, max(-11.0, sum(w[g] * x for g, x in zip(gates, inputs, strict=True))))
            cell = speak * c.REFINE + min(16, max(-16, round(2 * y))) + 16
            s = 1 / (1 + math.exp(-y))
            p, bit = min(1 - 1e-5, max(1e-5, 0.5 * s + 0.5 * apm[cell])), int(wants[k] == leaf)
            waiting.append((bit, s, gates, inputs, cell))
            total += math.log10(p if bit else 1 - p)
            if bit:
                break
            failed += p0
        else:
            total += float(coder.leaf_price[z, leaf]) - math.log10(max(1 - failed, 1e-6))
        out.append(total)
        like += coder.like[leaf]
    return sum(out)


def test_lm_coder_against_plain_version():
    import pyarrow as pa

    from quillgraph.llm import lm_context as c
    from quillgraph.llm.common import Words, flat
    from quillgraph.llm.lm import END_HASH

    rs = np.random.RandomState(15)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [vocabulary[i] for i in rs.randint(0, 60, 40)]
    texts = []
    for n in (0, 1, 5, 40, 150, 700, 2500):
        t = [vocabulary[min(59, int(i))] for i in rs.exponential(12, n)]
        for at in range(0, n - 40, 90):
            t[at : at + 40] = passage
        texts.append(" ".join(t))
    seen_of = lambda x: c.Seen(w := Words(*flat(pa.array(x))), w.hashes(), END_HASH)
    seen = seen_of(texts)
    keys, n = np.unique(seen.hash, return_counts=True)
    known = c.Known(keys[n > 3], np.arange(1, (n > 3).sum() + 1))
    leaf = known.find(seen.hash)
    counts = np.stack([np.bincount(leaf[:1500], minlength=len(known.keys) + 1), np.bincount(leaf[1500:], minlength=len(known.keys) + 1)], axis=1) + 0.5
    tree = c.Tree(counts)
    price = tree.prices(tree.fit(counts))
    assert ((10.0**price).sum(axis=1) < 1.001).all() and ((10.0**price).sum(axis=1) > 0.98).all()
    kraft = (0.5 ** tree.length).sum()
    assert abs(kraft - 1) < 1e-12 and len(set(zip(tree.code, tree.length, strict=True))) == len(counts)
    gather = c.Gather(3)
    parts = [*gather.add(seen_of(texts[3:]), known.find(seen_of(texts[3:]).hash)), *gather.flush()]
    table = np.zeros(1 << 15, np.uint32)
    for made in c.merge_entries(15, 3)(parts):
        p = made.column(0)[0].as_py()
        table[p * 4096 : (p + 1) * 4096] = np.frombuffer(zlib.decompress(made.column(1)[0].as_py()), np.uint32)
    # The table: the commonest follower of each context that is alone in its slot
    one = seen_of(texts[3:])
    for ctx in one.contexts():
        follow = defaultdict(Counter)
        for x, y in zip(ctx.tolist(), known.find(one.hash).tolist(), strict=True):
            follow[x][y] += 1
        want, level, _ = c.look_up(table, np.array(list(follow), np.uint64))
        right = [w == -1 or f[w] == max(f.values()) for w, f in zip(want.tolist(), follow.values(), strict=True)]
        assert all(right) and (want >= 0).mean() > 0.9
    weights = c.fit(tree.like, price, table, [(seen, leaf)])
    coder = c.Coder(tree.like, price, table, weights)
    for own in (False, True):
        got = np.bincount(seen.doc, weights=coder.price(seen, leaf, np.full(len(leaf), own)), minlength=len(texts))
        for d in range(len(texts)):
            a, b = seen.first[d], seen.first[d + 1]
            want = plain_price(coder, list(zip(leaf[a:b].tolist(), [int(x) for x in seen.hash[a:b]], strict=True)), own)
            assert math.isclose(got[d], want, rel_tol=2e-4, abs_tol=1e-4), (d, got[d], want)
    # Over all leaves at one place probabilities do not exceed one
    text = seen_of([" ".join(passage[:30])])
    own_leaf, total = known.find(text.hash), 0.0
    for x in range(len(counts)):
        own_leaf[-1] = x
        total += 10 ** coder.price(text, own_leaf, np.zeros(len(own_leaf), bool))[-1]
    assert 0.9 < total <= 1 + 1e-6


def test_lm_counts_of_a_task_are_put_together():
    import pyarrow as pa

    from quillgraph.llm.lm import Counted

    rs, held, out, want = np.random.RandomState(16), Counted(2, rows=64), [], defaultdict(lambda: np.zeros(2, int))
    for _ in range(40):
        key = np.unique(rs.randint(0, 50, 30)).astype(np.uint64)
        n = rs.randint(0, 5, (len(key), 2))
        for k, row in zip(key.tolist(), n, strict=True):
            want[k] += row
        out += held.add(key, pa.array([b"w%d" % k for k in key], pa.binary()), n)
    out += held.flush()
    # 50 distinct words stay one row each over all pieces of the task, where each piece gave out rows of its own
    rows = [r for x in out for r in x.to_pylist()]
    assert len(rows) == 50 and list(held.flush()) == []
    assert all(r["word"] == b"w%d" % r["h"] and [r["c0"], r["c1"]] == want[r["h"]].tolist() for r in rows)
    # Many distinct words, or long ones, are given out on the way
    held = Counted(2, rows=64, size=1000)
    assert sum(x.num_rows for i in range(4) for x in held.add(np.arange(100 * i, 100 * i + 100).astype(np.uint64), pa.array([b"x"] * 100, pa.binary()), np.ones((100, 2), int))) >= 200
    assert sum(x.num_rows for i in range(4) for x in held.add(np.array([7 + i], np.uint64), pa.array([b"y" * 5000], pa.binary()), np.ones((1, 2), int))) >= 1


def test_lm_entries_of_contexts_are_packed_without_loss():
    from quillgraph.llm import lm_context as c

    rs = np.random.RandomState(17)
    for n in (0, 1, 2, 5000):
        keys = np.unique(np.append(rs.randint(0, 1 << 63, n).astype(np.uint64) * np.uint64(2), np.array([2**64 - 1, 0, 5], np.uint64)[: min(n, 3)]))
        a, b = rs.randint(1, 200_000, len(keys)), rs.randint(1, 300, len(keys))
        got = c.unpack_entries(c.pack_entries(keys, a, b))
        assert all(np.array_equal(x, y) for x, y in zip(got, (keys, np.minimum(a, 60_000), b), strict=True))


def test_lm_first_weights_come_from_all_decisions():
    from quillgraph.llm import lm
    from quillgraph.llm import lm_context as c

    # Two predictors under known weights: the tally finds them, in any order and any parts of the decisions
    rs = np.random.RandomState(18)
    n = 60_000
    speak = rs.choice([12, 14], n)  # the second predictor is silent, the first against or for (as is the third)
    side = np.array([speak // 3**e % 3 - 1 for e in range(3)])
    sure = rs.randint(0, 2, n) * 4
    x = np.round(rs.uniform(-6, 2, n) * 4) / 4
    gates = np.array([speak, *[c.gate_of_word(e, sure, speak) for e in range(3)]])
    inputs = np.array([x, *side])
    z = np.where(speak == 14, 0.6, 1.3) * x + (side != 0).sum(axis=0) * np.where(sure > 0, 1.5, -0.5)
    bit = rs.uniform(size=n) < 1 / (1 + np.exp(-z))
    found = []
    for order in (np.arange(n), rs.permutation(n)):
        tally = c.Tally(most=1000)
        for part in np.array_split(order, 7):
            tally.add(bit[part], speak[part], gates[:, part], inputs[:, part])
        tally.join()
        assert tally.n.sum() == n
        found.append(c.learned(tally.keys, tally.n))
    assert np.array_equal(found[0].w, found[1].w) and np.array_equal(found[0].apm, found[1].apm)
    assert abs(found[0].w[14] - 0.6) < 0.05 and abs(found[0].w[12] - 1.3) < 0.1
    assert np.allclose(c.learned(np.zeros(0, np.int64), np.zeros(0, np.int64)).w, 1)
    # The mixer of spellings: a round over a 32nd of the decisions and one over all others find them, in one part or in ten
    n, true, mixers = 400_000, rs.uniform(0.1, 0.6, (5, 1)), []
    st, b = rs.normal(0, 1.5, (5, n)).astype(np.float32), rs.randint(0, 6, (5, n))
    bit = (rs.uniform(size=n) < 1 / (1 + np.exp(-(true * st).sum(axis=0)))).astype(int)
    for parts in (1, 10):
        m = lm.Mixer(5)
        for own in (np.arange(n // 32), np.arange(n // 32, n)):
            told = np.zeros(m.size())
            for i in np.array_split(own, parts):
                m.tally(list(st[:, i]), list(b[:, i]), bit[i], np.ones(len(i)), told)
            m.step(told)
        mixers.append(m)
    assert np.allclose(mixers[0].w, mixers[1].w, atol=1e-5)
    assert np.abs(mixers[0].w.reshape(5, -1)[:4].mean(axis=1) - true[:4, 0]).max() < 0.05
    assert np.isclose(mixers[0].told[1].sum(), n)


def test_lm_learns_first_weights_from_more_texts_than_a_sample_holds(spark, monkeypatch):
    from quillgraph.llm import lm_context as c
    from quillgraph.llm.lm import held_out, score

    # Every decision of every training text is tallied: 150,000 words, more than the first weights were drawn from
    rs, told = np.random.RandomState(19), []
    docs = spark.createDataFrame([(i, make_text(rs, 300, ["alpha", "beta", "gamma", "delta"]), "en", "a", 1) for i in range(620)], DOC)
    monkeypatch.setattr(c, "learned", lambda keys, n, own=c.learned: told.append(int(n.sum())) or own(keys, n))
    got = score(docs).where("NOT held_out").selectExpr("sum(n_tokens) AS n").first().n
    assert docs.where(~held_out("doc_id")).count() * 300 < got and got > 140_000
    assert told[0] > 0.9 * got  # a word of four has a decision at least where any context expects one


def test_lm_repeats_of_other_words():
    from quillgraph.llm.lm import first_of, repeats

    doc, h = np.array([0, 0, 0, 0, 1, 1]), np.array([5, 6, 5, 5, 5, 7], np.uint64)
    again, told = repeats(doc, h)
    assert again.tolist() == [False, False, True, True, False, False]
    assert np.bincount(first_of(doc, h, again)).tolist() == [3, 1, 1, 1]
    want = [0, math.log10(1 - 0.5 / 2), math.log10(0.5 / 3 * 1 / 2), math.log10(1.5 / 4 * 2 / 3), 0, math.log10(1 - 0.5 / 2)]
    assert np.allclose(told, want)
    assert len(repeats(doc[:0], h[:0])[0]) == 0


def test_lm_probabilities_do_not_exceed_one():
    from quillgraph.llm import lm

    # Over all one-byte words and the empty one, a speller's probabilities stay below one
    speller = lm.Speller(np.zeros((lm._START[-1], 2), np.uint16), lm.Mixer(lm.K), np.zeros((lm.SHAPES, 2)))
    data = np.array([b for b in range(256) if b != 32], np.uint8)
    _, one = speller.score(data, np.arange(len(data) + 1))
    _, none = speller.score(np.zeros(0, np.uint8), np.array([0, 0]))
    assert (10**one).sum() + 10 ** none[0] <= 1


def test_lm_words_outside_the_dictionary_keep_their_counts(spark):
    from quillgraph.llm.lm import held_out, score, shared_out

    # Two spellings that look alike, one seen 30 times as often as the other, both outside of a dictionary of few words
    rs = np.random.RandomState(13)
    common = [make_text(rs, 60, ["alpha", "beta", "gamma"]) for _ in range(400)]
    rare = [f"qz{i:03d}" for i in range(100)]
    for k, w in enumerate(rare):
        for j in range(30 if k % 2 else 1):
            common[(k * 7 + j * 3) % 400] += " " + w
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(common)], DOC).withColumn("out", held_out("doc_id")).where("NOT out").drop("out")
    asked = [r.i for r in spark.range(10_000, 10_400).select(F.col("id").alias("i"), held_out("id").alias("o")).collect() if r.o][:60]
    probes = spark.createDataFrame([(i, rare[20 + k], "en", "a", 1) for k, i in enumerate(asked)], DOC)
    got = {r.doc_id: r.score for r in score(df.unionByName(probes), max_dictionary=4).collect()}
    often, seldom = ([got[i] for k, i in enumerate(asked) if k % 2 == x] for x in (1, 0))
    assert np.mean(often) > np.mean(seldom) + 0.7
    # What all words can get is at most 1
    c, spelled = np.array([30, 1, 2, 0, 0]), np.log10([0.1, 0.2, 0.3, 0.2, 0.1])
    assert (10 ** shared_out(c, spelled, 33.0, 3.0, 0.5)).sum() <= 1


def test_lm_without_training_documents(spark):
    from quillgraph.llm.lm import score

    i = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    df = spark.createDataFrame([(i, "a b", "en", "", 0)], DOC)
    r = score(df).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0) and r.base_score == 0
    assert score(df.limit(0)).count() == 0


# ------------------------------------------------------------------ pipeline


def linked_groups(docs, share):
    """Components of documents by brute force over all pairs: doc_id -> smallest doc_id."""
    sets = {}
    for r in docs:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or ""))
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, x in enumerate(ids):
        for y in ids[:k]:
            a, b = sets[x], sets[y]
            if a and b and 100 * len(a & b) >= share * len(a | b):
                p, q = find(x), find(y)
                up[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_pipeline_stages_and_run(spark, tmp_path, monkeypatch):
    import corpus_pipeline as p
    from quillgraph.llm.bpe import encode, production_vocabulary
    from quillgraph.llm.common import Scratch

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        before = docs.collect()
        text = {r.doc_id: r.text for r in before}
        words = {i: WORD.findall(t) for i, t in text.items()}
        ids = Counter(r.doc_id for r in out.select("doc_id").collect())
        if k < len(p.STAGES) - 1:
            assert out.columns == columns
            assert all(text[r.doc_id] == r.text for r in out.collect())
        if name == "toxicity":
            toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.toxic}
            assert len(toxic - set(ids)) >= 0.5 * len(toxic) and len(ids) >= 0.9 * (len(text) - len(toxic))
        if name == "quality_rules":
            assert set(ids) == {i for i, w in words.items() if plain_verdict(w)}
        if name == "near_dup":
            group = linked_groups(before, 80)
            assert ids == Counter(set(group.values()))
        if name == "mixing":
            # Whole documents; words taken are nearest to the target but for the document in which it is met
            source, size, taken = {r.doc_id: r.source for r in before}, Counter(), Counter()
            for i, w in words.items():
                size[source[i]] += len(w)
                taken[source[i]] += len(w) * ids[i]
            want = water_fill(size)
            most = {s: max(len(w) for i, w in words.items() if source[i] == s) for s in size}
            assert all(abs(taken[s] - want[s]) <= most[s] / 2 + 1 for s in size) and max(ids.values()) <= 4
        if name == "bpe":
            assert ids == Counter(r.doc_id for r in before)
            assert sorted(map(tuple, out.collect())) == sorted(map(tuple, encode(docs, production_vocabulary()).collect()))
        docs = out
    # run() is these stages one after the other, and leaves one table in the shared folder
    live = len(Scratch.live)
    assert sorted(map(tuple, p.run(spark, sf).collect())) == sorted(map(tuple, docs.collect()))
    assert len(Scratch.live) == live + 1


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    import corpus_pipeline as p

    # Every name that a stage uses for itself, as columns of the documents
    odd = odd_rows(spark)
    for c in ("kept", "copy", "share", "target", "taken", "h", "u", "q", "bucket", "maybe", "keys", "k1", "n", "whole_copies", "source_size", "row"):
        odd = odd.withColumn(c, F.lit("clash"))
    learned = [i for i in range(1, 8) if zlib.crc32(str(i).encode()) % 5]
    labels = [(i, int(i == learned[0])) for i in learned] + [(learned[0], None), (None, 1)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    want = {
        "toxicity": ["1", "2", "3", "4", "5", "6", "6", "7", "None"],
        "near_dup": ["1", "2", "3", "4", "5", "6", "7", "None"],
    }
    for name, stage in p.STAGES:
        for df in (odd, odd.limit(0)):
            out = stage(spark, df, str(tmp_path))
            rows = out.collect()
            if name != "bpe":
                assert out.columns == odd.columns
                assert all(r.n == r.kept == r.copy == "clash" and r.label == 3 for r in rows)
            if name in want and rows:
                assert sorted(str(r.doc_id) for r in rows) == want[name]
            if name == "mixing":
                assert all(WORD.search(r.text) for r in rows)
            assert rows or df is not odd or name == "quality_rules"


def test_pipeline_keeps_rows_without_id(spark):
    import corpus_pipeline as p

    df = odd_rows(spark).select(*[c.split()[0] for c in DOC.split(", ")])
    out = p.drop_near_duplicates(spark, df, "").collect()
    assert sorted([str(r.doc_id) for r in out]) == sorted(["1", "2", "3", "4", "5", "6", "7", "None"])


def test_bloom_filter_has_no_false_negatives(spark):
    from quillgraph.llm.bloom import Bloom

    rs = np.random.RandomState(11)
    ids = rs.randint(-(1 << 62), 1 << 62, 5000)
    own = Bloom(spark.createDataFrame([(int(i),) for i in ids] + [(None,)], "id long"), "id")
    assert own.mask(ids).all() and own.mask(rs.randint(-(1 << 62), 1 << 62, 20_000)).mean() < 0.05
    df = spark.createDataFrame([(int(ids[0]),), (None,)], "id long").withColumn("m", own.column("id"))
    assert [r.m for r in df.collect()] == [True, False]


def test_keep_one_of_repeated_rows(spark):
    from quillgraph.llm.near_dup import keep_one

    rs = np.random.RandomState(12)
    text = make_text(rs, 200)
    rows = [(1, text, "", "a", 1), (2, text, "", "a", 1), (1, text, "", "a", 1), (3, make_text(rs, 200, [f"u{i}" for i in range(500)]), "", "a", 1), (None, text, "", "a", 1)]
    got = sorted(str(r.doc_id) for r in keep_one(spark.createDataFrame(rows, DOC)).collect())
    assert got == ["1", "3", "None"]


def test_keep_one_of_rows_that_share_an_id(spark):
    from quillgraph.llm.near_dup import keep_one, near_duplicates

    rs = np.random.RandomState(17)
    a, b, c = (make_text(rs, 120, [f"{x}{i}" for i in range(400)]) for x in "abc")
    # 5 has two texts that have nothing in common, one of them is also that of 2; the other of 9 and, nearly, of 8
    rows = [(2, a, "x", "a", 1), (5, a, "x", "b", 1), (5, b, "x", "c", 1), (9, b, "x", "d", 1), (8, b + " end", "x", "e", 1), (7, c, "x", "f", 1), (7, c, "x", "f", 1), (7, c, "y", "f", 1), (3, "", "", "g", 0), (3, None, "", "h", 0)]
    df = spark.createDataFrame(rows, DOC).withColumn("kept", F.lit(1)).withColumn("n", F.lit("clash")).withColumn("odd_id", F.lit(2)).withColumn("k1", F.array(F.lit(1)))
    got = keep_one(df)
    assert got.columns == df.columns
    rows = sorted((r.doc_id, r.source) for r in got.collect())
    assert rows == [(2, "a"), (3, "g"), (3, "h"), (5, "c"), (7, "f")]
    assert sorted(map(str, keep_one(df.repartition(5)).collect())) == sorted(map(str, got.collect()))
    component = Counter((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert component == Counter({(2, 2, True): 1, (5, 2, False): 1, (5, 5, True): 1, (9, 5, False): 1, (8, 5, False): 1, (7, 7, True): 3, (3, 3, True): 2})
    assert keep_one(df.limit(0)).count() == 0


def test_pipeline_links_near_copies_at_80_percent(spark):
    import corpus_pipeline as p
    from quillgraph.llm.near_dup import near_duplicates

    # 196 shingles each: 176 of 216 are shared (0.815) by 1 and 2, 172 of 220 (0.782) by 3 and 4
    words = [f"w{i}" for i in range(400)]
    a, b = words[:200], words[200:]
    texts = [a, a[:180] + [f"x{i}" for i in range(20)], b, b[:176] + [f"y{i}" for i in range(24)]]
    df = spark.createDataFrame([(i, " ".join(t), "", "a", 1) for i, t in enumerate(texts, 1)], DOC)
    assert all(r.kept for r in near_duplicates(df).collect())
    assert sorted(r.doc_id for r in p.drop_near_duplicates(spark, df, "").collect()) == [1, 3, 4]


# ------------------------------------------------------------------ clashing names, repeats and very long values


def test_bpe_ignores_other_columns_of_its_own_names(spark):
    from quillgraph.llm.bpe import encode, production_vocabulary

    df = odd_rows(spark)
    want = sorted(map(str, encode(df, production_vocabulary()).collect()))
    for c in ("n_tokens", "ids_sha256", "decoded_sha256", "ids"):
        df = df.withColumn(c, F.lit("clash"))
    assert sorted(map(str, encode(df, production_vocabulary()).collect())) == want and len(want) == df.count()


def test_chat_of_very_long_texts_and_ties(spark):
    from quillgraph.llm.chat import rotate

    long = "word " * 200_000
    rows = [(1, 1, "user", long), (1, 1, "user", "tie"), (1, 1, "user", "tie"), (1, 2, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("speaker", F.lit("clash")).withColumn("perspective", F.lit("clash"))
    got = rotate(df).collect()
    assert len(got) == 8 and sum(long in r.rendered for r in got) == 2 and sum("tie" in r.rendered for r in got) == 4


def test_urls_that_repeat_or_are_very_long(spark):
    from quillgraph.llm.urls import judge

    rows = [(i, u) for i, u in enumerate(["http://a.com/fr/1", "http://b.com/de/2", "http://c.net/x"])] * 2 + [(9, "http://c.net/" + "y/" * 100_000), (None, None)]
    got = judge(spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("clash"))).collect()
    assert len(got) == len(rows) and all(n in (1, 2) for n in Counter((r.page_id, r.verdict) for r in got).values())
    assert {r.page_id: len(r.path) for r in got}[9] == 200_001
