"""The registered queries against SQL, plain versions, other libraries and held-out labels."""

import hashlib
import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import SMALL, duck, same  # noqa: E402
from filewright.llm import bpe, decontam, embed, grams, langid, ngram_join, pii, substring, toxicity  # noqa: E402
from filewright.llm.common import components, mix64, rolling, sliding_min, split_by  # noqa: E402
from filewright.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

MIDDLE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    same(spark, duck(), QUERIES[name], ORACLE_SQL[name])


def test_rolling_and_minima():
    h = np.random.default_rng(1).integers(0, 1 << 63, 200, np.int64).astype(np.uint64)
    for width in (1, 2, 3, 5, 12, 50, 200):
        plain = [sum(int(x) * pow(7, width - 1 - j, 1 << 64) for j, x in enumerate(h[i : i + width])) % (1 << 64) for i in range(len(h) - width + 1)]
        assert rolling(h, width, 7).tolist() == plain
        assert sliding_min(h, width).tolist() == [int(min(h[i : i + width])) for i in range(len(h) - width + 1)]
    assert len(rolling(h, 201, 7)) == 0 and len(set(mix64(h).tolist())) == len(set(h.tolist()))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_split_by(spark):
    df = spark.range(5000).withColumnRenamed("id", "k").union(spark.sql("select cast(null as long)"))
    maybe, never = split_by(df, "k", spark.range(0, 5000, 7), "id")
    inside = {r.k for r in maybe.collect()}
    assert {*range(0, 5000, 7)} <= inside and len(inside) < 1000 and maybe.count() + never.count() == 5001


def test_bpe_is_tiktoken(spark):
    ranks = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    table = bpe.PerfectHash(ranks)
    assert sorted(table.keys) == sorted(ranks) and all(table.get(k) == r for k, r in ranks.items()) and table.get(b"no such entry at all") is None
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op5_byte_bpe"](spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = encoding.encode_ordinary(r.text or "")
        o = got[r.doc_id]
        assert (o.n_tokens, o.ids_sha256, o.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    codec = bpe.Codec(ranks, table, P.PATTERN)
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("aab \n1'sé中\U0001f600<|endoftext|>") for _ in range(rng.randrange(60)))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == encoding.encode_ordinary(text)


def test_join_is_brute_force(spark):
    base = [f"w{i}" for i in range(90)]
    rng = random.Random(7)
    texts = []
    for i in range(150):
        words = list(base if i < 120 else [f"v{i}x{j}" for j in range(60)])
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for width, num, den in ((3, 90, 100), (5, 80, 100)):
        sets = {i: set(zip(*(t.split()[k:] for k in range(width)))) for i, t in texts}
        parent = {i: i for i in sets}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a in sets:
            for b in range(a):
                n = len(sets[a] & sets[b])
                if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs, width, num, den).collect()}
        assert got == {i: (len(sets[i]), find(i)) for i in sets}


def test_join_query_is_brute_force(spark):
    texts = {r.doc_id: (r.text or "").encode().lower().split() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    sets = {i: {tuple(w[k : k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set()) for i, w in texts.items()}
    where = defaultdict(list)
    for i in sorted(sets):
        for g in sets[i]:
            where[g].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j, n in Counter(j for g in sets[i] for j in where[g] if j < i).items():
            if 100 * n >= 90 * (len(sets[i]) + len(sets[j]) - n):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op3_ngram_join"](spark, SMALL).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}


def test_decontamination_is_brute_force(spark):
    docs = {r.doc_id: decontam.words_of(r.text) for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").limit(400).collect()}
    items = {r.item_id: decontam.words_of(r.text) for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()}
    rng = random.Random(2)
    for i, item in list(items.items())[:10]:  # near copies as well: a word changed near one end, words around
        near = list(item)
        near[1] = "changed"
        docs[10**6 + i] = [f"z{rng.random()}" for _ in range(30)] + near + ["tail"] * 9
    expect = set()
    for d, words in docs.items():
        for i, item in items.items():
            k = min(5, len(item))
            own, all_ = Counter(zip(*(item[j:] for j in range(k)))), list(zip(*(words[j:] for j in range(k))))
            m = len(item) - k + 1
            for a in range(len(all_) - m + 1):
                if all_[a] in own or all_[a + m - 1] in own:
                    here = Counter(all_[a : a + m])
                    if sum((here & own).values()) >= 0.8 * sum((here | own).values()):
                        expect.add((d, i))
                        break
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    bench = spark.read.parquet(f"{MIDDLE}/benchmark.parquet")
    assert {(r.doc_id, r.item_id) for r in decontam.find(df, bench).collect()} == expect and len(expect) > 8
    assert {(r.doc_id, r.item_id) for r in decontam.find(df, bench, block_words=200).collect()} == expect  # in blocks of items


def test_decontamination_of_shorter_documents(spark):
    """A document that is the item less some words, at either end, is compared as a whole."""
    bench = spark.read.parquet(f"{MIDDLE}/benchmark.parquet")
    items = {r.item_id: decontam.words_of(r.text) for r in bench.collect()}
    items |= {10**6: [f"w{i}" for i in range(30)], 10**6 + 1: ["one", "two", "three"], 10**6 + 2: ["again"] * 40}
    docs = {}
    for i, item in list(items.items())[:12] + list(items.items())[-3:]:
        for less in (1, 2, 4, 6, 9):
            for part in (item[less:], item[:-less], item[: len(item) // 2] + item[len(item) // 2 + less :]):
                docs[len(docs)] = part
    expect = {}
    for d, words in docs.items():
        for i, item in items.items():
            k = min(5, len(item))
            own, all_ = (list(zip(*(w[j:] for j in range(k)))) for w in (item, words))
            m = min(len(own), len(all_))
            best = max((sum((Counter(all_[a : a + m]) & Counter(own)).values()) / sum((Counter(all_[a : a + m]) | Counter(own)).values()) for a in range(len(all_) - m + 1)), default=0)
            if best >= 0.8:
                expect[d, i] = (best, min(len(item), len(words)))
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.n_words) for r in decontam.find(df, bench).collect()}
    assert got == expect and len({d for d, _ in expect}) > 40
    assert {r.doc_id for r in decontam.drop_contaminated(df, bench).collect()} == set(docs) - {d for d, _ in expect}


def plain_base(text):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(re.sub("[ -]", "", m.group())) <= 19 and pii.luhn(re.sub("[ -]", "", m.group()))]
    return out + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_pii_base_is_the_rules(spark):
    rng = random.Random(3)
    for i in range(5000):
        text = "".join(rng.choice("019.+-@ ()a%é5.1") for _ in range(rng.randrange(40)))
        text = text.replace("é", "1.2.3.4").replace("%", "a@b.c") if i % 2 else text
        assert pii.base_spans(text) == plain_base(text), text
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in QUERIES["op6_pii"](spark, SMALL).collect():
        base = plain_base(texts[r.doc_id])
        written = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest() and (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in base) for x in range(4))
        assert not base or set(written.split(",")) <= set(r.spans.split(","))


def test_pii_field_joins_repeats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    field = pii.Field.train(pii._sample(docs, pii.TRAINING_DOCS))
    text = "call +1 (269) 555-3296 now; later 269 555 3296, not 7654321 or 555-9999"
    spans, known, base = pii.tokens_of(text)
    assert base == [(3, 5, 22)] and [text[a:b] for _, a, b in pii.added_spans(text, field, spans, known)] == ["269 555 3296"]
    # resembling a phone elsewhere in the text makes the same number surer
    beside, alone = field.marginals(["+1 (269) 555-3296", "269 555 3296"], [3, None])[1], field.marginals(["269 555 3296"], [None])[0]
    assert beside[3] > 0.99 > alone[3] and beside[3] > alone[3]


def test_pii_marginals_are_enumerated():
    """On trees the marginals are those of all labellings weighed one by one; on loops they are close."""
    from itertools import product

    rng = np.random.default_rng(3)
    labels = pii.OTHER + 1
    field = pii.Field(rng.normal(size=(len(pii.features("")), labels)), rng.normal(size=(labels, labels)) * 0.5, np.eye(labels) * 1.5)
    field.chain = (field.chain + field.chain.T) / 2
    cases = [(["5551234567"], [None], 1e-6), (["a@b", "5551234567", "7654321"], [None, None, None], 1e-6), (["a@b", "x@c", "4845168114407329", "12.34.56.789"], [0, None, None, None], 1e-6)]
    cases += [(["555 123 4567", "a@b", "5551234567"], [None, None, None], 0.08), (["555 123 4567", "a@b", "5551234567", "a (at) c dot d", "7654321"], [3, None, None, None, None], 0.08)]
    for tokens, known, close in cases:
        skips = pii.skip_edges(tokens)
        edges = [(i, i + 1, field.chain) for i in range(len(tokens) - 1) if (i, i + 1) not in skips] + [(a, b, field.skip) for a, b in skips]
        logs = np.array([pii.features(t) for t in tokens]) @ field.unary
        exact = np.zeros((len(tokens), labels))
        for way in product(range(labels), repeat=len(tokens)):
            if all(k is None or k == w for k, w in zip(known, way)):
                weight = np.exp(sum(logs[i, w] for i, w in enumerate(way) if known[i] is None) + sum(t[way[a], way[b]] for a, b, t in edges))
                for i, w in enumerate(way):
                    exact[i, w] += weight
        exact /= exact.sum(1, keepdims=True)
        old, pii.ROUNDS = pii.ROUNDS, 60
        try:
            assert abs(field.marginals(tokens, known) - exact).max() < close, tokens
        finally:
            pii.ROUNDS = old


def test_pii_beyond_the_rules(spark):
    """A planted table: personal data written as no rule says, beside numbers that are none."""
    rng = random.Random(21)

    def card():
        body = "".join(rng.choice("0123456789") for _ in range(15))
        return next(body + d for d in "0123456789" if pii.luhn(body + d))

    rows, planted = [], {}
    phone = lambda: f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    for i in range(400):
        kind = i % 8
        number = card()
        wrong = number[:-1] + str((int(number[-1]) + 3) % 10)
        said, found = {
            0: (f"pay with {number} today", None), 1: (f"ring +1 {phone()} or write joe.{i}@mail{i % 7}.example.com", None), 2: (f"host {i % 250}.7.9.{i % 199} is up", None),
            3: (f"ticket {wrong} of {20}24-0{1 + i % 9}-11 closed", None), 4: (f"write to ann.{i} (at) example{i % 5}.org soon", f"ann.{i} (at) example{i % 5}.org"),
            5: (f"ring {(p := phone())} soon", p), 6: (f"cards {number} {number}", number), 7: ("nothing to see at home or at work", None),
        }[kind]
        rows.append((i, said))
        if found:
            planted[i] = found
    got = {r.doc_id: [tuple(x.split(":")) for x in r.spans.split(",") if x] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    added = {i: [said[int(a) : int(b)] for k, a, b in got[i] if (pii.KINDS.index(k), int(a), int(b)) not in pii.base_spans(said)] for i, said in rows}
    hit = sum(planted[i] in added[i] for i in planted)
    total = sum(map(len, added.values()))
    right = sum(planted.get(i) == x for i, xs in added.items() for x in xs)
    assert hit >= 0.9 * len(planted) and right >= 0.95 * total, (hit, len(planted), right, total)


def test_pii_is_linear():
    import time

    field = pii.Field.train([(["+1 (269) 555-3296", "a@b.example"], [3, 0])] * 5)
    text = " , ".join(f"{i:07d}" for i in range(20_000)) + " +1 (269) 555-3296 and 269 555 3296"
    began = time.time()
    pii.added_spans(text, field, *pii.tokens_of(text)[:2])
    assert time.time() - began < 8


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op1_toxicity"](spark, MIDDLE).join(docs, "doc_id").where("held_out").collect()
    wrong = [r for r in rows if r.predicted != r.toxic]
    assert len(rows) > 100 and len(wrong) <= 0.05 * len(rows) and not [r for r in wrong if r.toxic == 0]


def test_toxicity_model_is_kneser_ney(spark):
    """Every byte's ratio is that of the class distributions, worked out by their definition from plain counts."""
    order, d = 4, toxicity.DISCOUNT
    rng = random.Random(4)
    texts = [(i % 2, " ".join("".join(rng.choice("abc" if i % 2 else "abd") for _ in range(rng.randrange(1, 5))) for _ in range(6))) for i in range(24)]
    table = sorted((r.gram, r.n0, r.n1) for r in grams.count_texts(spark.createDataFrame(texts, "label int, text string"), 2, order).collect())
    model = toxicity.KneserNey(grams.Tree(np.array([g for g, _, _ in table]), order), np.array([n for _, *n in table], float))
    n = [Counter(), Counter()]
    for label, text in texts:
        line = f" {text} "
        for i in range(len(line)):
            for k in range(1, min(order, i + 1) + 1):
                n[label][line[i + 1 - k : i + 1]] += 1
    assert {bytes.fromhex(f"{g & (1 << 56) - 1:014x}")[7 - (g >> 56) :].decode(): (a, b) for g, a, b in table} == {g: (n[0][g], n[1][g]) for g in {*n[0], *n[1]}}
    every = {*n[0], *n[1]}
    cont = Counter(g[1:] for g in every if len(g) > 1)
    after = defaultdict(Counter)
    for g, m in cont.items():
        after[g[:-1]][g[-1]] = m

    def shared(context, byte):
        back = shared(context[1:], byte) if context else 1 / 256
        total = sum(after[context].values())
        return (max(after[context][byte] - d, 0) + min(d, total) * len(after[context]) * back) / total if total else back

    def level(c, context, byte, back):
        follows = {g[-1]: m for g, m in n[c].items() if g[:-1] == context}
        total = sum(follows.values())
        return (max(follows.get(byte, 0) - d, 0) + d * len(follows) * back) / total if total else back

    def known(context):
        return all(any(g[:-1] == context for g in n[c]) for c in (0, 1))

    def likelihood(c, context, byte, expressions):
        space = context.rfind(" ")
        if space > 0:  # into the word before
            back = likelihood(c, context[1:], byte, expressions)
            return level(c, context, byte, back) if expressions and known(context) else back
        if space == 0 or len(context) == order - 1:
            return level(c, context, byte, shared(context[1:], byte))
        return shared(context, byte)

    for text in ("ab c", "abc dab", "dd cc", "zz", "a z bcd", texts[3][1], texts[4][1]):
        line, at, _ = grams.line_of([text], order)
        whole = line.tobytes().decode()
        plain = np.zeros((len(whole), 2))
        for i in range(1, len(whole)):
            context = whole[max(0, i - order + 1) : i]
            plain[i] = [np.log(likelihood(1, context, whole[i], e) / likelihood(0, context, whole[i], e)) for e in (False, True)]
        assert abs(model.bytes_of(line, at) - plain).max() < 1e-4, text
        words = model.words([None, text, " ", text])
        assert [len(w) for w in words] == [0, len(text.split()), 0, len(text.split())] and abs(words[1].sum(0) - plain.sum(0)).max() < 1e-3 and (words[1] == words[3]).all()


def test_toxicity_of_expressions(spark):
    """Neither word of a toxic expression is toxic by itself: contexts cross the space between words."""
    rng = random.Random(9)
    first, second = ["ka", "lo", "mi"], ["bet", "dur", "fen"]
    rude = {("ka", "bet"), ("lo", "dur"), ("mi", "fen")}
    pairs = [(a, b) for a in first for b in second]
    texts = [(i, int(i % 3 == 0), " ".join(w for _ in range(30) for w in rng.choice(sorted(rude) if i % 3 == 0 else [p for p in pairs if p not in rude]))) for i in range(900)]
    docs, labels = spark.createDataFrame([(i, t) for i, _, t in texts], "doc_id long, text string"), spark.createDataFrame([(i, x) for i, x, _ in texts], "doc_id long, toxic int")
    got = [(r.predicted, texts[r.doc_id][1]) for r in toxicity.score(docs, labels, toxicity.default_held_out()).collect() if r.held_out]
    assert len(got) > 250 and all(p == t for p, t in got), Counter(got)


def test_line_in_pieces():
    line, at, n = grams.line_of(["Ab  c", None, "", "x\ty z" * 50], 6)
    assert line.tobytes().startswith(b" ab c  x y zx") and n.tolist() == [2, 0, 0, 101] and at[:8].tolist() == [0, 1, 2, 3, 4, 5, 0, 1]
    whole = grams.longest_keys(line, at, 6)
    for size in (1, 7, 64):
        assert np.concatenate([k for _, _, k in grams.pieces(line, at, 6, size)]).tolist() == whole.tolist()


def test_toxicity_of_words_that_ordinary_texts_hold_too(spark):
    """Toxic texts hold some words about 50 times as often as ordinary ones: many such words tell."""
    rng = random.Random(8)
    name = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    plain, rude = [name() for _ in range(300)], [name() for _ in range(20)]
    rows = [(i, int(i % 4 == 0), " ".join(rng.choice(rude if rng.random() < (0.25 if i % 4 == 0 else 0.005) else plain) for _ in range(80))) for i in range(1200)]
    docs = spark.createDataFrame([(i, text) for i, _, text in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, toxic) for i, toxic, _ in rows], "doc_id long, toxic int")
    got = [(r.predicted, rows[r.doc_id][1]) for r in toxicity.score(docs, labels, toxicity.default_held_out()).collect() if r.held_out]
    assert len(got) > 300 and sum(p != t for p, t in got) <= 0.02 * len(got), Counter(got)


def test_language_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op4_language"](spark, MIDDLE).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 150 and sum(r.lang_pred == r.lang for r in rows) >= 0.99 * len(rows)


def each_bits(model, word):
    """The cost of each byte of a word and of the space after it, by the definition of PPM with exclusion."""
    line, _, at = grams.packed([word], model.tree.order)
    keys = grams.keys(line, at, model.tree.order)
    out = []
    for i in range(1, len(line)):
        excluded, cost, done = set(), 1.0, False
        for k in range(min(i, model.tree.order - 1), -1, -1):
            context = bytes(line[i - k : i])
            seen = {}
            for g, n in zip(model.tree.grams.tolist(), model.counts[:, 0].tolist()):
                body = (g & ((1 << 56) - 1)).to_bytes(7, "big")[7 - (g >> 56) :]
                if len(body) == k + 1 and body[:-1] == context:
                    seen[body[-1]] = n
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            whole = sum(left.values()) + len(left)
            if line[i] in left:
                cost *= left[line[i]] / whole
                done = True
                break
            if left:
                cost *= len(left) / whole
            excluded |= set(seen)
        if not done:
            cost /= max(1, 256 - len(excluded))
        out.append(-np.log2(cost))
    assert len(keys) == model.tree.order
    return out


def last_bits(model, word):
    return each_bits(model, word)[-1]


def prefix_bits(model, word):
    return sum(each_bits(model, word)[:-1])


def test_ppm_is_a_code():
    """The probabilities of all bytes after a context sum to 1, and an unseen word costs more than a seen one."""
    words = [b"abra", b"abrac", b"cab", b"bad"]
    line, word, at = grams.packed(words, 4)
    found, counts = np.unique(np.concatenate([k[k > 0] for k in grams.keys(line, at, 4)]), return_counts=True)
    model = langid.ContextTrees(grams.Tree(found, 4), counts[:, None].astype(float))
    model.counts = counts[:, None]
    for context in (b"", b"a", b"ab", b"abr", b"zz"):
        # a word is its bytes and the space after it: leave that last byte's cost out by asking for it alone
        total = 0.0
        for b in [x for x in range(256) if x != 32]:
            whole = model.score([context + bytes([b])])[0, 0]
            total += 2.0 ** -(whole - last_bits(model, context + bytes([b])) - prefix_bits(model, context))
        total += 2.0 ** -each_bits(model, context)[-1]  # the space
        assert abs(total - 1) < 1e-4, context
        assert abs(model.score([context + b"r"])[0, 0] - sum(each_bits(model, context + b"r"))) < 1e-3
    assert model.score([b"abra"])[0, 0] < model.score([b"qqqq"])[0, 0]


def test_trees_of_several_languages():
    """Languages share a tree: each one's code lengths are those of a tree of its own; lookups by hash find every gram."""
    rng = random.Random(12)
    word = lambda: bytes(rng.choice(b"abcd") for _ in range(rng.randrange(1, 7)))
    learnt = [[word() for _ in range(60)] for _ in range(3)]
    tables = []
    for words in learnt:
        line, _, at = grams.packed(words, 4)
        tables.append(Counter(np.concatenate([k[k > 0] for k in grams.keys(line, at, 4)]).tolist()))
    found = np.array(sorted(set().union(*tables)))
    counts = np.array([[t[g] for t in tables] for g in found.tolist()], float)
    tree = grams.Tree(found, 4)
    assert tree.find(found).tolist() == list(range(len(found))) and (tree.find(found + 1) == tree.rows(found + 1)).all()
    asked = [word() for _ in range(200)] + [b"xyz", b"a" * 9, b"dx"]
    whole = langid.ContextTrees(tree, counts).score(asked)
    for c, table in enumerate(tables):
        own = np.array(sorted(table))
        alone = langid.ContextTrees(grams.Tree(own, 4), np.array([[table[g]] for g in own.tolist()], float))
        assert abs(whole[:, c] - alone.score(asked)[:, 0]).max() < 1e-4


def test_cache_of_words():
    """Scores are the same however often the cache lets words go."""
    scores = grams.WordScores(lambda words: np.array([[len(w), w[0]] for w in words], float), 2, most=50)
    rng = random.Random(1)
    for _ in range(60):
        texts = [[f"{rng.choice('ab') * rng.randrange(1, 30)}".encode() for _ in range(rng.randrange(20))] for _ in range(5)]
        assert [s.tolist() for s in scores.of(texts)] == [[[len(w), w[0]] for w in t] for t in texts]


def test_counts_of_grams(spark):
    texts = [(0, "abra cadabra abra"), (1, "abracadabra"), (0, None), (1, ""), (1, "é x")]
    got = {r.gram: (r.n0, r.n1) for r in grams.count(spark.createDataFrame(texts, "label int, text string"), 2, 4).collect()}
    expect = defaultdict(lambda: [0, 0])
    for label, text in texts:
        for w in grams.words_of(text):
            whole = b" " + w + b" "
            for i in range(len(whole)):
                for k in range(1, min(4, i + 1) + 1):
                    expect[int.from_bytes(whole[i + 1 - k : i + 1], "big") | k << 56][label] += 1
    assert got == {g: tuple(n) for g, n in expect.items()}


def test_models_hold_every_gram(spark):
    """However many grams there are, the rarest of the smallest class stay."""
    n = 1_600_000
    counts = spark.range(n).select(F.col("id").alias("gram"), F.when(F.col("id") % 2 == 0, 3).otherwise(0).cast("long").alias("n0"), (F.col("id") % 2).alias("n1"))
    found, per = grams.collect(counts, 2)
    assert (found == np.arange(n)).all() and per.sum(0).tolist() == [3 * n / 2, n / 2]


def test_embedding_recall(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    copies = x[:400] + rng.normal(size=(400, 64)) * rng.uniform(0.01, 0.06, size=(400, 1))
    x = np.concatenate([x, copies, x[:1] + rng.normal(size=(300, 64)) * 0.02]).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = (unit @ unit.T >= embed.THRESHOLD).sum(1) - 1
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    for block in (embed.BLOCK, 64):  # small blocks: the large group becomes many tasks
        got = {r.vec_id: r.n_links for r in embed.near_duplicates(table, cell=100, block=block).collect()}
        found = np.array([got[i] for i in range(len(x))])
        assert (found <= linked).all() and found.sum() >= 0.97 * linked.sum() > 0


def test_embedding_recall_with_many_cells(spark):
    """A third of the rows is one group of near vectors, which draws a third of the centroids; pairs at 0.9 lie apart."""
    rng = np.random.default_rng(6)
    rows = lambda n: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.normal(size=(n, 64)))
    alone = rows(1500)
    across = rng.normal(size=alone.shape)
    across -= (across * alone).sum(1, keepdims=True) * alone
    pairs = 0.902 * alone + np.sqrt(1 - 0.902**2) * across / np.linalg.norm(across, axis=1, keepdims=True)
    x = np.concatenate([np.sqrt(0.95) * rows(1) + np.sqrt(0.05) * rows(1500), alone, pairs]).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = (unit @ unit.T >= embed.THRESHOLD).sum(1) - 1
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in embed.near_duplicates(table, cell=9, sample=1500).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= linked).all()
    for group in (slice(0, 1500), slice(1500, None)):
        assert found[group].sum() >= 0.99 * linked[group].sum() > 0, found[group].sum() / linked[group].sum()


def test_substring_intervals():
    assert substring.intervals(np.array([5, 1, 2, 60, 200]), 50) == [(1, 55), (60, 110), (200, 250)] and substring.intervals(np.array([], int), 50) == []


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
        assert out.columns == columns and 0 < out.count() <= docs.count(), name
        docs = out
    assert docs.count() < before
    assert ngram_join.join(docs, 5, 80, 100).where("component_id <> doc_id").count() == 0
    assert decontam.find(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).count() == 0
    out = pipeline.STAGES[-1][1](spark, docs, SMALL).where(F.size("ids") != F.col("n_tokens"))
    assert out.count() == 0


def test_signatures_bound_differences():
    """Signatures and their folds differ in no more bits than the sets in n-grams, and by as many modulo two."""
    import numpy as np

    from filewright.llm.ngram_join import FOLD, signature

    rng = np.random.default_rng(5)
    bits = lambda v: sum(int(x).bit_count() for x in v.view(np.uint64))
    for size, gone, new in ((0, 0, 0), (1, 1, 1), (60, 3, 5), (900, 40, 0), (20_000, 500, 700)):
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[min(gone, len(a)) :], rng.integers(0, 2**63, new, dtype=np.uint64)]))
        apart = len(np.setxor1d(a, b))
        whole = signature(a) ^ signature(b)
        folded = np.bitwise_xor.reduce(whole.reshape(FOLD, -1), axis=1)
        for n in (bits(whole), bits(folded)):
            assert n <= apart and (apart - n) % 2 == 0
