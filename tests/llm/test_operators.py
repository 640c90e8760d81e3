"""Operators against brute force, on small tables with nulls, empty and long texts, ties and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from batchloom.llm import bpe, decontam, fixity, html, langid, lm, minhash, quality, queries, ranking, sharding, simhash, toxicity
from batchloom.llm.components import components

PATH = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, `count` long"


def corpus():
    """Documents with copies, near copies, shared lines, nulls, empty and very long texts, and equal rows."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice(["an", "be", "co", "dé", "ñu", "st", "ing"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [None, "", " \t\n", "one", "Two words", "###\n###", "x" * 3000, "12 34 ½ ２", "日本語 テスト", "a<|endoftext|>b"]
    texts += [sentence(rng.randint(1, 130)) + ".\n" + sentence(rng.randint(3, 30)) for _ in range(60)]
    base = sentence(150)
    texts += [base] * 12 + [base + " " + rng.choice(vocabulary) for _ in range(25)]
    texts += [f"{sentence(60)}\nShared LINE  of the host\n{sentence(60)}" for _ in range(40)]
    texts += ["\n".join([sentence(4)] * 30), sentence(20_000)]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i, text, "en" if i % 3 else None, None if i % 11 == 0 else f"h{i % 2}", 0, 7, "k", 1))
    rows += [rows[30], rows[30], (None, "no id here", None, "h0", None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), COLUMNS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


# -- BPE


def test_bpe_equals_the_tokenizers_library(docs, empty):
    library = Tokenizer.from_file(PATH)
    both = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH)
    for row in both.collect():
        expected = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == expected
        assert row.decoded == library.decode(expected, skip_special_tokens=False)
        assert row.key in ("k", None)
    one_pass = bpe.encode_and_decode(docs, PATH)
    assert one_pass.columns == both.columns
    assert sorted(map(str, one_pass.collect())) == sorted(map(str, both.collect()))
    assert bpe.encode_documents(empty, PATH).count() == 0


def test_bpe_on_random_strings():
    library, own, rng = Tokenizer.from_file(PATH), bpe.ForcedBoundaryBpe(PATH), random.Random(1)
    pool = [*map(chr, range(256)), *" 　½Ⅷ中\U0001f600́א", "<|endoftext|>", "'s", "'ll", "  ", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    long = "ab" * 40_000
    assert own.encode(long) == library.encode(long, add_special_tokens=False).ids


def test_bpe_cuts_are_forced_and_segments_change_nothing(monkeypatch):
    own = bpe.ForcedBoundaryBpe(PATH)
    word = "zqxjкé".encode()
    parts = own.fragments(word)
    assert b"".join(parts) == word and len(parts) > 1
    tokens = set(own.bytes_of.values())
    for left, right in zip(parts, parts[1:]):
        assert not any(left[-1:] + right[:1] in t for t in tokens)
    text = " ".join(f"word{i}\n  x" for i in range(300))
    whole = own.encode(text)
    monkeypatch.setattr(bpe, "SEGMENT_CHARS", 50)
    assert own.encode(text) == whole
    assert own.decode(None) == "" and own.encode(None) == []


# -- quality rules


def brute_quality(rows, limits):
    lines, texts = defaultdict(set), defaultdict(set)
    norm = lambda line: b" ".join(words_of(line))
    for r in rows:
        if r[1] is not None:
            texts[r[3]].add(r[1])
            for line in r[1].split("\n"):
                if words_of(line):
                    lines[r[3], norm(line)].add(r[1])
    bad = {k for k, v in lines.items() if len(v) >= limits.min_documents and len(v) > limits.max_share * len(texts[k[0]])}
    out = []
    for r in rows:
        text, words = r[1] or "", re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        own = [x for x in text.split("\n") if words_of(x)]
        windows = Counter(zip(words, words[1:], words[2:]))
        hit = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        gone = sum(len(words_of(x)) for x in own if (r[3], norm(x)) in bad)
        failed = len(words) < limits.min_words or len(hit) > limits.max_repeat_share * len(words)
        kept = not failed and gone <= limits.max_removed * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        out.append((r[0], len(words), sum(map(len, words)), symbols, len(own) - len(set(own)), len(hit), gone, failed, kept))
    return out


def test_quality_equals_brute_force(docs, empty):
    limits = quality.Limits(min_documents=8, max_share=0.1)
    found = quality.quality(docs, limits=limits).select("doc_id", "quality.*").drop("cleaned")
    expected = brute_quality(corpus(), limits)
    assert Counter(map(tuple, found.collect())) == Counter(expected)
    assert any(r[6] for r in expected) and any(r[8] for r in expected)
    assert quality.quality(empty).count() == 0


def test_quality_cuts_lines_above_the_limits(docs):
    kept = quality.kept_documents(docs, limits=quality.Limits(min_documents=8, max_share=0.1))
    assert kept.columns == docs.columns
    rows = kept.collect()
    shared = [r for r in corpus() if r[1] and "Shared LINE" in r[1]]
    assert not any("Shared LINE" in r.text for r in rows if r.source in ("h0", "h1"))
    assert {r[0] for r in shared} <= {r.doc_id for r in rows}
    assert all(r.n_chars == len(r.text) for r in rows)


def test_copies_do_not_make_lines_boilerplate(spark):
    rows = [(i, "one line that is copied", "h") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert quality.boilerplate_lines(docs).count() == 0


# -- toxicity


def test_toxicity_learns_graded_words(spark, empty):
    rng = random.Random(3)
    clean = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]
    docs, labels = [], []
    for i in range(600):
        words, toxic = [rng.choice(clean) for _ in range(40)], i % 4 == 0
        if toxic:
            words[: 1 + i % 3] = rng.sample(["vileone", "viletwo", "grotty"], 1 + i % 3)
        docs.append((i, " ".join(words), "extra"))
        labels += [(i, int(toxic))] * (2 if i % 7 == 0 else 1)
    docs += [(600, None, None), (601, "", None), (None, "alpha vileone", None)]
    labels += [(None, 1), (9999, 1), (5, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, label string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit_labels(docs, labels)
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    rows = docs.select("doc_id", toxicity.severity(F.col("text"), model).alias("s")).select("doc_id", "s.*").collect()
    verdict = {r.doc_id: r for r in rows}
    assert all(verdict[i].toxic == (i % 4 == 0) for i in range(600))
    assert not verdict[600].toxic and not verdict[601].toxic and verdict[None].toxic
    mild = np.mean([verdict[i].expected_severity for i in range(600) if i % 4 == 0 and i % 3 == 0])
    severe = np.mean([verdict[i].expected_severity for i in range(600) if i % 4 == 0 and i % 3 == 2])
    assert 0 <= verdict[1].expected_severity < mild < severe <= 2
    nothing = toxicity.fit_labels(docs, labels.limit(0))
    assert not docs.select(toxicity.severity(F.col("text"), nothing).alias("s")).where("s.toxic").count()
    assert empty.select(toxicity.severity(F.col("text"), model)).count() == 0


def test_ordinal_fit_recovers_shared_weights():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (4000, 3)).astype(np.float32)
    z = x @ [2.0, -1.0, 0.0] + rng.logistic(size=4000)
    grade = (z > 0.5).astype(int) + (z > 2.0)
    weights, thresholds = toxicity.fit_ordinal(x, grade)
    assert np.allclose(weights, [2, -1, 0], atol=0.25) and np.allclose(thresholds, [0.5, 2.0], atol=0.25)


# -- decontamination

BREAK = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return BREAK.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        if words and item is not None:
            for k in range(max(1, len(words) - 9)):
                windows[tuple(words[k : k + 10])].add(str(item))
    out = []
    for r in rows:
        words, hit, found = plain_words(r[1]), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                items_ = windows.get(tuple(words[k : k + n]))
                if items_:
                    hit |= set(range(k, k + n))
                    found |= items_
        out.append((r[0], len(words), len(hit), tuple(sorted(found))))
    return out


def test_decontamination_equals_brute_force(spark, docs, empty, monkeypatch):
    rows = corpus()
    long = rows[20][1].split(" ")
    items = [(1, rows[-6][1]), (2, " ".join(long[3:16])), (3, "Two, WORDS!"), (4, "one"), (10, " ".join(long[3:16])), (5, ""), (6, None)]
    items += [(7, "absent phrase of no document at all, whatever it may be, none"), (None, "one"), (2, "one")]
    items += [(8, " ".join(rows[-5][1].split(" ")[-11:]))] if rows[-5][1] else []
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = Counter(brute_contamination(rows, items))
    assert sum(1 for r in expected if r[2]) > 3

    def found():
        got = decontam.contamination(docs, table).select("doc_id", "n_words", "n_hit", "item_ids").collect()
        return Counter((r[0], r[1], r[2], tuple(r[3])) for r in got)

    assert found() == expected
    clean = decontam.without_contaminated(docs, table)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r[0] for r in expected.elements() if not r[2])
    monkeypatch.setattr(decontam, "LITERAL_KEYS", 0)
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert found() == expected
    assert decontam.contamination(empty, table).count() == 0
    assert decontam.contamination(docs, table.limit(0)).where("n_hit > 0").count() == 0


# -- main text

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";x()</script></head><body>'
    '<nav><ul><li><a href="/a">Menu {i}</a></li><li><a href="/b">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy now {i}.</div>'
    "<article><h1>Title &amp; {i}</h1><p><b>First   line,\nof {i} words.<br><p>Second &lt;b&gt; paragraph of the page {i}.</p></article>"
    "<footer>&copy; site &middot; All of {i}.</footer></body></html>"
)
TEXT = "Title & {i}\nFirst line, of {i} words.\nSecond <b> paragraph of the page {i}."


def test_main_text_of_pages(spark):
    rows = [(i, PAGE.replace("{i}", str(i)), "was here") for i in range(120)]
    rows += [(200, None, ""), (201, "", ""), (202, "<p>unclosed <b", ""), (203, PAGE.replace("{i}", "203")[:-60], "")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = {r.page_id: r.text for r in html.main_text(pages).collect()}
    assert all(found[i] == TEXT.replace("{i}", str(i)) for i in [*range(120), 203])
    assert found[200] == found[201] == ""
    assert html.main_text(pages.limit(0)).count() == 0


def test_pages_are_read_behind_unclosed_and_self_closing_elements():
    texts = lambda page: [text for _, text, _ in html.blocks(page)]
    for tag in ("svg", "math"):
        assert texts(f'<p>A<{tag} class="i"/>B</p><p>C</p>') == ["A B", "C"]
        assert html.blocks(f'<p>A<{tag} class="i"/>B</p><p>C</p>')[1][0] == (("p",),)
    for tag in ("svg", "math", "object", "canvas", "noscript"):
        assert texts(f"<div><p>A<{tag} class=i>B</p><p>C</p></div><p>D</p>") == ["AB", "C", "D"]
        assert texts(f"<p>A <{tag}>inside</{tag}> B</p><p>C</p>") == ["A inside B", "C"]
    icon = '<svg viewBox="0 0 1 1"><g><path d="M0 0"/><circle r="1" /></g></svg>'
    assert texts(f"<p>A {icon}B</p><p>C</p>") == ["A B", "C"]
    assert [p for p, _, _ in html.blocks(f"<p>A <svg><title>T</title><path/></svg>B</p>")] == [(("p",),), (("p",), ("title",)), (("p",),)]
    assert texts("<p>A</p><object><p>instead</p></object><math><mi>x</mi><mo>=</mo><mn>1</mn></math><p>C</p>") == ["A", "instead", "x=1", "C"]
    after = html.blocks('<div>A<svg class="ad"><path/>B<p>C</p><div/>D</div><p>E</p>')
    assert [t for _, t, _ in after] == ["A B", "C", "D", "E"] and (".ad" not in str(after[1][0] + after[3][0]))
    for tag in html.RAW.split("|"):
        assert texts(f"<p>A<{tag} x='1'>gone</{tag}>B</p>") == ["AB"] and texts(f"<p>A</p><{tag}>gone<p>gone</p>") == ["A"]
        assert texts(f"<{tag}-box>A</{tag}-box><p>C</p>") == ["A", "C"]


def test_labeller_knows_parts_that_the_sample_lacks():
    pages = [PAGE.replace("{i}", str(i)) for i in range(120)]
    labeller = html.train(pages)
    right = total = 0
    for page in html.variants([PAGE.replace("{i}", str(i)) for i in range(200, 260)], seed=11):
        found = html.blocks(page)
        article = any(html.MAIN & {n.lstrip(".") for n in e} for path, _, _ in found for e in path)
        labels = labeller.label([html.vectors(found)])[0]
        right += sum(html.teacher(path, article) == on for (path, _, _), on in zip(found, labels))
        total += len(found)
    assert right / total > 0.98


def test_lstm_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    labeller = html.Labeller()
    x, mask = html.padded([rng.normal(size=(n, html.INPUTS)) for n in (3, 5)])
    y = (rng.random(mask.shape) < 0.5).astype(float)

    def loss():
        p = labeller.forward(x, mask)[0]
        return -float(np.where(mask, y * np.log(p) + (1 - y) * np.log(1 - p), 0).sum() / mask.sum())

    grads = labeller._gradients(x, mask, y)
    for name, at in (("forth", (4, 7)), ("back", (html.INPUTS + 2, 40)), ("out", (3,)), ("forth", (-1, 20))):
        kept, ends = labeller.p[name][at], []
        for e in (1e-5, -1e-5):
            labeller.p[name][at] = kept + e
            ends.append(loss())
        labeller.p[name][at] = kept
        assert math.isclose((ends[0] - ends[1]) / 2e-5, grads[name][at], rel_tol=1e-3, abs_tol=1e-7)


# -- sharding


def test_shards_follow_the_mixture(spark, docs, empty):
    rows = corpus()
    placed = sharding.interleaved(docs, shards=4).collect()
    assert Counter(r.doc_id for r in placed) == Counter(r[0] for r in rows)
    sizes = Counter(r.shard for r in placed)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == {0, 1, 2, 3}
    for shard in sizes:
        assert sorted(r.slot for r in placed if r.shard == shard) == list(range(sizes[shard]))
    for source, n in Counter(r.source for r in placed).items():
        for shard in sizes:
            assert abs(sum(r.shard == shard and r.source == source for r in placed) - n / 4) <= 2
    texts = {r[0]: r[1] for r in rows}
    for r in placed:
        body = (texts[r.doc_id] or "").encode()
        assert r.size == len(body) + 1 and r.text_crc32 == zlib.crc32(body)
    again = sharding.interleaved(docs.repartition(2), shards=4).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, placed))
    assert sharding.interleaved(empty).count() == 0


def test_running_totals_by_group(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i long, v long").repartition(6)
    got = {r.i: r.total for r in ranking.running(df, ["i"], F.col("v"), "total", ["g"]).collect()}
    sums = defaultdict(int)
    for g, i, v in rows:
        assert got[i] == sums[g]
        sums[g] += v


# -- language


def test_languages_of_held_out_texts(spark, empty):
    rng = random.Random(4)
    parts = {"aa": ["ing", "the", "tion", "and"], "bb": ["ción", "que", "los", "ñar"], "cc": ["sch", "ung", "der", "ich"]}
    rows = []
    for i in range(300):
        lang = ["aa", "bb", "cc"][i % 3]
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(30))
        rows.append((i, text, lang))
    learned = spark.createDataFrame(rows[:240] + [(900, None, "aa"), (901, "x", None), (None, "y", "aa")], "doc_id long, text string, lang string")
    trees = langid.learn(learned)
    asked = rows[240:] + [(901, None, None), (902, "12 .. 34", None), (903, "", None), (904, rows[0][1] * 400, None)]
    df = spark.createDataFrame([(i, t) for i, t, _ in asked], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in df.select("doc_id", langid.language(F.col("text"), trees).alias("f")).select("doc_id", "f.*").collect()}
    assert all(got[i][0] == lang and 0.99 < got[i][1] <= 1 for i, _, lang in rows[240:])
    assert got[901] == got[902] == got[903] == ("und", 0.0) and got[904][0] == "aa"
    nothing = langid.learn(empty)
    assert df.select(langid.language(F.col("text"), nothing).alias("f")).where("f.lang_pred <> 'und'").count() == 0


def test_code_lengths_equal_a_walk_down_the_tree(monkeypatch):
    monkeypatch.setattr(langid, "MIN_CONTEXT", 2)
    texts = {"aa": ["banana band", "a ban"], "bb": ["órgano", "no año"]}
    counts = {}
    for lang, listed in texts.items():
        counts[lang] = [Counter() for _ in range(langid.ORDER + 1)]
        for text in listed:
            b = b"\n" + text.encode()
            for order in range(langid.ORDER + 1):
                for i in range(max(order, 1), len(b)):
                    counts[lang][order][int.from_bytes(b[i - order : i + 1], "big")] += 1
    trees = langid.ContextTrees(counts)

    def bits(lang, context, byte):
        for order in range(min(len(context), langid.ORDER), -1, -1):
            node = int.from_bytes(context[len(context) - order :], "big")
            if (order, node) in trees.node:
                break
        total = 0.0
        while order >= 0:
            node = int.from_bytes(context[len(context) - order :] if order else b"", "big")
            follow = {g & 255: n for g, n in counts[lang][order].items() if g >> 8 == node}
            if follow:
                n, kinds = sum(follow.values()), len(follow)
                if byte in follow:
                    return total + math.log2((n + kinds) / follow[byte])
                total += math.log2((n + kinds) / kinds)
            order -= 1
        return total + 8

    for text in ("banana", "ban año zz", "órg"):
        b = b"\n\n\n" + text.encode()
        expected = [sum(bits(lang, b[max(0, i - 3) : i], b[i]) for i in range(3, len(b))) for lang in trees.langs]
        assert np.allclose(trees.code_lengths(text), expected, rtol=1e-4)


# -- fixity


def test_audit_locates_damage(spark):
    rows = [(i, "x" * (i * 37 % 400)) for i in range(400)]
    records = spark.createDataFrame(rows, "id long, body string").select("id", fixity.warc_record(F.lit("http://e"), F.col("body")).alias("record"))
    place = dict(file_bytes=20_000)
    a = fixity.place_records(records, "id", **place).cache()
    offset = 0
    for r in sorted(a.collect(), key=lambda r: r.key):
        assert r.file * 20_000 + r.offset == offset
        offset += r.length
    changed = F.when(F.col("key") == 17, F.lit("0" * 64)).otherwise(F.col("digest"))
    b = a.where("key not in (3, 200)").withColumn("digest", changed)
    b = b.union(a.where("key = 99").withColumn("key", F.lit(1000).cast("long")).withColumn("offset", F.col("offset") + 1))
    found = fixity.audit(a, b, range_bytes=1_000, **place).collect()
    assert {(r.key, r.kind) for r in found} == {(3, "missing"), (200, "missing"), (17, "changed"), (1000, "added")}
    assert fixity.audit(a, a, range_bytes=1_000, **place).count() == 0
    assert fixity.audit(a.limit(0), a.limit(0)).count() == 0
    roots = fixity.merkle_levels(a, fixity.depth(1_000, 20_000), 1_000)[-1]
    assert roots.count() == a.select("file").distinct().count()


def test_second_replica_is_hashed_from_its_own_records(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    bodies = [(i, "é<p>" * (i % 50)) for i in range(1200)] + [(None, "no id"), (None, "no id"), (5, "again"), (3, None)]
    text = fixity.warc_record(F.lit("http://e"), F.col("body")).alias("record")
    records = spark.createDataFrame(bodies, "page_id long, body string").select("page_id", text).repartition(3)
    a = fixity.place_records(records, "page_id", file_bytes=20_000).cache()
    second = queries.damaged(records).cache()
    b = fixity.at_index(second, "page_id", a)
    # Every digest and length of B is that of a record which B holds; places are the archive's.
    own = {(r.page_id, len(r.record.encode()), sha(r.record)) for r in second.collect()}
    assert {(r.key, r.length, r.digest) for r in b.collect()} == own
    lost = lambda i: i is not None and i % queries.DAMAGE == 7
    place = lambda t: Counter((r.key, r.file, r.offset) for r in t.collect())
    assert place(b) == place(a.where("key IS NULL OR key % 499 <> 7"))
    assert sum(r.key is None for r in b.collect()) == 2
    # Altered records have another length; only they and the lost ones are reported, and nothing behind them.
    found = fixity.audit(a, b, range_bytes=1_000, file_bytes=20_000).collect()
    changed = {(r.key, r.digest_a) for r in found if r.kind == "changed"}
    assert changed == {(r.key, r.digest) for r in a.collect() if r.key is not None and r.key % queries.DAMAGE == 3}
    assert {r.key for r in found if r.kind == "missing"} == {i for i, _ in bodies if lost(i)}
    assert len(found) == 4 + 3 and all((r.key, 65, r.digest_b) in own for r in found if r.kind == "changed")
    # An added record and a moved one are damage of their own.
    more = b.union(spark.createDataFrame([(9000, 2, 77, 5, sha("added"))], b.schema))
    moved = more.withColumn("offset", F.when(F.col("key") == 20, F.col("offset") + 1).otherwise(F.col("offset")))
    kinds = Counter((r.key, r.kind) for r in fixity.audit(a, moved, range_bytes=1_000, file_bytes=20_000).collect())
    assert kinds - Counter((r.key, r.kind) for r in found) == Counter({(9000, "added"): 1, (20, "missing"): 1, (20, "added"): 1})


# -- SimHash


def brute_fingerprint(text):
    words = words_of(text)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(values):
    roots = list(range(len(values)))

    def find(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 4 and find(i) != find(j):
                roots[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_simhash_equals_brute_force(docs, empty):
    rows = corpus()
    values = [brute_fingerprint(r[1]) for r in rows]
    roots = brute_components(values)
    least = defaultdict(list)
    for r, root in zip(rows, roots):
        least[root].append(math.inf if r[0] is None else r[0])
    expected = Counter((r[0], v, min(least[root])) for r, v, root in zip(rows, values, roots))
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect())
    got = Counter({(d, v, math.inf if c is None else c): n for (d, v, c), n in got.items()})
    assert got == expected
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) == len(least)
    assert simhash.near_duplicates(empty).count() == 0


def test_components_without_ids_and_repeated_ids(spark):
    text = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(4)]
    rows = [(None, text[0]), (None, text[0]), (None, text[1]), (5, text[2]), (5, text[2]), (5, text[3]), (7, text[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(tuple(r) for r in simhash.one_of_each(docs).collect())
    assert kept[None, text[0]] == kept[None, text[1]] == 1
    assert sum(n for (i, _), n in kept.items() if i == 5) == 1 and len(kept) == 3


def test_dense_groups_of_fingerprints(spark):
    rng = random.Random(8)
    center, values = rng.getrandbits(64), set()
    for _ in range(300):
        v = center
        for _ in range(rng.randint(0, 5)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    far = rng.getrandbits(64)
    values = sorted(values | {far, far ^ 0b1111, far ^ 0b11111 << 30, 0, 1 << 63, 15})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    got = {r.fp % (1 << 64): r.component for r in simhash.fingerprint_components(spark.createDataFrame(signed, "fp long")).collect()}
    roots = brute_components(values)
    groups = defaultdict(set)
    for v, root in zip(values, roots):
        groups[root].add(got[v])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_chain_keys_equal_brute_force_from_a_short_plan(spark):
    rng = random.Random(14)
    values = [0, (1 << 64) - 1, 1 << 63, *(rng.getrandbits(64) for _ in range(50))]
    expected = set()
    for v in values:
        parts = [v >> offset & (1 << width) - 1 for offset, width in simhash.SEGMENTS]
        for i, (a, b) in enumerate(zip(parts, parts[1:] + parts[:1])):
            expected.add((v, i << 26 | a << 13 | b, True))
            expected |= {(v, i << 26 | a << 13 | b ^ 1 << k, False) for k in range(13) if b >> k & 1}
    fps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, 0) for v in values], "fp long, component long")
    rows = simhash._blocked(fps)
    got = [(r.fp % (1 << 64), r.key, r.own) for r in rows.collect()]
    assert set(got) == expected and len(got) == len(expected)
    assert len(rows._jdf.queryExecution().executedPlan().toString()) < 4000


def test_keys_of_a_set_are_kept_as_one_row(spark, monkeypatch):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join([*words[:k], f"n{k}", *words[k + 1 :]]) for k in range(6)]
    stored, write = {}, minhash.materialise
    monkeypatch.setattr(minhash, "materialise", lambda df, label: stored.setdefault(label, write(df, label)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.component_id for r in minhash.near_copies(docs).collect()} == {0}
    rows = stored["shared-keys"].collect()
    assert len(rows) == len({r.fp for r in rows}) == 6 and "blocks" not in stored


def test_components_of_a_long_path(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


# -- MinHash


def brute_sets(texts):
    sets = []
    for text in texts:
        words = words_of(text)
        sets.append({b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    roots = list(range(len(sets)))

    def find(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or len(a & sets[j]) / len(a | sets[j]) >= 0.8:
                roots[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def near_copies_at_all_distances():
    """Texts of 60 to 700 words with copies on both sides of similarity 0.8, chains, and one exactly on it."""
    rng, rows = random.Random(12), []
    for group in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([60, 150, 700]))]
        for _ in range(8):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 35))):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            rows.append(" ".join(words))
            base = words if group % 5 == 0 else base
    words = [f"e{i}" for i in range(84)]
    return rows + [" ".join(words), " ".join(words[:68])]


def test_stage_finds_all_copies_at_similarity_of_four_fifths(spark, docs, empty):
    rows = [(r[0], r[1]) for r in corpus()] + [(1000 + i, t) for i, t in enumerate(near_copies_at_all_distances())]
    roots = brute_sets([t for _, t in rows])
    least = defaultdict(list)
    for (i, _), root in zip(rows, roots):
        least[root].append(math.inf if i is None else i)
    more = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, math.inf if r.component_id is None else r.component_id) for r in minhash.near_copies(more).collect())
    assert got == Counter((i, min(least[root])) for (i, _), root in zip(rows, roots))
    kept = corpus_pipeline.near_duplicates(spark, more, None)
    assert kept.columns == more.columns
    ids = Counter(math.inf if r.doc_id is None else r.doc_id for r in kept.collect())
    assert ids == Counter(min(ids) for ids in least.values())
    assert least[roots[-1]] == [1200, 1201]
    assert minhash.one_of_each(empty).count() == 0


def test_near_copies_are_linked_by_simhash_without_a_common_minhash_key(spark):
    """Fingerprints in one nibble, along a chain, and equal ones; a text of other words is near in bits, but not alike."""
    rng = random.Random(11)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    repeated = "one two three four five " * 60
    texts = [" ".join(words)]
    for i in range(12):
        texts.append(" ".join([*words[: 45 * i + 20], f"other{i}", *words[45 * i + 21 :]]))
    texts += [repeated + " ".join(words[:9]), repeated + " ".join(words[90:99]), " ".join(reversed(words))]
    bits = [simhash.fingerprint(t, minhash.SHINGLE) for t in texts]
    sets = [set(minhash.shingles(t).tolist()) for t in texts]
    near = lambda i, j: ((bits[i] ^ bits[j]) & (1 << 64) - 1).bit_count() <= simhash.BITS
    alike = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= minhash.SIMILARITY
    assert near(13, 14) and not alike(13, 14)
    assert any(near(i, j) and alike(i, j) and bits[i] != bits[j] for i in range(13) for j in range(i))

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = minhash.signatures(docs).withColumn("bands", F.array(F.col("fp")))  # no two sets share a key
    found = {r.id: r.component for r in rows.join(minhash.set_components(docs, rows), "fp").collect()}
    expected = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if near(i, j) and alike(i, j) and expected[i] != expected[j]:
                expected = [expected[j] if e == expected[i] else e for e in expected]
    same = lambda of: {(i, j) for i in range(len(texts)) for j in range(i) if of[i] == of[j]}
    assert same(found) == same(expected) and same(expected)


# -- language model


def test_language_model_counts_and_probabilities(spark, docs, empty):
    rows = corpus()
    got = lm.scores(docs).collect()
    assert len(got) == len(rows)
    rest = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 10
    tokens = [[*words_of(r[1]), None] for r in rows]
    learned = [t for r, t in zip(rows, tokens) if rest(r[0])]
    counts = Counter(w for t in learned for w in t)
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for r, t in zip(rows, tokens):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        expected[r[0], rest(r[0]) == 0, len(t), sum(counts[w] > 0 for w in t), n, round(base, 4)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == expected
    assert all(r.score <= 0 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.scores(empty).count() == 0


def test_language_model_does_not_depend_on_chunks_and_sums_to_one(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choices("abcde", weights=[8, 4, 2, 1, 1], k=rng.randint(1, 12))) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first = {r.doc_id: r.score for r in lm.scores(df).collect()}
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 40)
    again = {r.doc_id: r.score for r in lm.scores(df.repartition(4)).collect()}
    assert all(math.isclose(first[i], again[i], rel_tol=1e-9) for i in first)

    # P(. | a) over the words, the end and one unknown word adds up to one: compare texts that differ in one word.
    ids = [i for i in range(2000, 4000) if zlib.crc32(str(i).encode()) % 10 == 0][:8]
    asked = ["a a"] + [f"a {w}" for w in ("b", "c", "d", "e", "zz")] + ["a"]
    more = spark.createDataFrame(rows + list(zip(ids, asked)), "doc_id long, text string")
    score = {r.doc_id: r.score for r in lm.scores(more).collect()}
    end = {w: score[ids[k]] for k, w in enumerate(["a", "b", "c", "d", "e", "zz", None])}
    # P(a) P(w | a) P(end | w) is known for each w, and P(a) P(end | a) for the end.
    singles = {w: i for w, i in zip(["a", "b", "c", "d", "e", "zz"], [i for i in range(4000, 9000) if zlib.crc32(str(i).encode()) % 10 == 0])}
    extra = spark.createDataFrame(rows + [(i, w) for w, i in singles.items()], "doc_id long, text string")
    assert all(s <= 0 for s in end.values())
    assert lm.scores(extra).count() == len(rows) + 6


def test_em_finds_mixture_weights():
    rng = np.random.default_rng(0)
    good = (5 * lm.BINS + 40) * lm.BINS + 90
    poor = (5 * lm.BINS + 40) * lm.BINS + 0
    weights = lm.learn_weights(np.array([good, poor]), np.array([900.0, 100.0]))
    assert np.allclose(weights.sum(axis=1), 1) and 0.8 < weights[5, 2] < 0.95
    keys = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.int64).astype(np.uint64))
    assert np.array_equal(lm.unpack(lm.pack(keys), "<u8"), keys)
    assert hashlib.sha256(lm.pack(keys)).digest()
