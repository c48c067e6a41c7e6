import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landloom.llm import language, leaks, packing
from landloom.llm.leaks import find_leaks, tiles, tokens

ITEM = "The tract described by Gregory Gemgudgor contains 344.84 acres more or less out of the Pavmeblas Survey, Abstract 638, and is subject to the easement filed in Volume 366, Page 205. A gap of 1,227.50 feet was noticed by Katherine Matbonbal."
STOCK = ITEM.replace("Gregory Gemgudgor", "Ann Lotbim").replace("344.84", "9.1").replace("Pavmeblas", "Kodnux").replace("638", "1").replace("366", "2").replace("205", "3").replace("1,227.50", "4.2").replace("Katherine Matbonbal", "Bo Dus")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=30), st.lists(st.sampled_from("abcdx"), max_size=40))
def test_tiles_match_and_do_not_overlap(a, b):
    found = tiles(a, b)
    assert all(a[i:i + k] == b[j:j + k] and k >= 2 for i, j, k in found)
    for side in (0, 1):
        spots = [s for t in found for s in range(t[side], t[side] + t[2])]
        assert len(spots) == len(set(spots))
    used_a, used_b = {s for i, _, k in found for s in range(i, i + k)}, {s for _, j, k in found for s in range(j, j + k)}
    # Greedy: no pair of neighbouring unmarked words is left on both sides.
    for i in range(len(a) - 1):
        for j in range(len(b) - 1):
            if not {i, i + 1} & used_a and not {j, j + 1} & used_b:
                assert a[i:i + 2] != b[j:j + 2]


def test_tokens_lose_notation():
    assert tokens("The <b>c0rrecti0n</b> of $1,227.50 [sic] on 06/02/2010") == tokens("the correction of 1227.5 on 6/2/2010")


def test_leaks(spark):
    words = ITEM.split()
    filler = "Taxes were paid late because the notice had been sent to an old box. " * 3
    docs = {
        1: filler + ITEM.upper() + filler, 2: filler + " ".join(words[3:33]), 3: filler + STOCK, 4: filler + " ".join(words[3:15]), 5: "", 6: None, 7: ITEM.replace(" ", "\n").replace("described", "[sic] described").replace("and", "as well as"),
        8: (filler * 400) + ITEM + filler, 9: ITEM,
    }
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    items = spark.createDataFrame([(50, ITEM), (51, "nothing of the kind here"), (52, None), (53, "")], "item_id long, item_text string")
    got = {(r["doc"], r["item"]) for r in find_leaks(df, "doc_id", "text", items, "item_id", "item_text").collect()}
    assert got == {(d, 50) for d in (1, 2, 7, 8, 9)}
    assert find_leaks(df.limit(0), "doc_id", "text", items, "item_id", "item_text").count() == 0
    assert find_leaks(df, "doc_id", "text", items.limit(0), "item_id", "item_text").count() == 0


def test_leaks_of_passages_with_few_seeds(spark):
    # The passage has one figure that is long enough to be a seed; its other figures are short.
    passage = "to repair the transmission line on notice of 42 days the south boundary of it runs S 16 34 E for about 2135.5 feet and then leaves the road"
    docs = [(1, f"Taxes were paid late because the notice had been sent to an old box. {passage}. The barn was burned."), (2, passage.replace("42", "9").replace("16 34", "8 7").replace("2135.5", "12.25")), (3, " ".join(passage.split()[9:]))]
    items = [(i, f"The owner has the right {passage} to the north.") for i in range(60, 65)]
    found = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", spark.createDataFrame(items, "item_id long, item_text string"), "item_id", "item_text")
    assert {(r["doc"], r["item"]) for r in found.collect()} == {(1, i) for i in range(60, 65)}


def test_repeated_items_and_blocks_of_items_lose_nothing(spark, monkeypatch):
    rng = np.random.default_rng(8)
    names = [f"{a}{b}" for a in ("Kod", "Bal", "Mir", "Lum", "Fen", "Gud") for b in ("nux", "mat", "ler", "dus", "gan", "pav", "bim")]
    texts = [ITEM.replace("Gemgudgor", rng.choice(names)).replace("Pavmeblas", rng.choice(names)).replace("Matbonbal", rng.choice(names)).replace("638", str(rng.integers(100, 999))).replace("344.84", f"{rng.integers(1, 999)}.{rng.integers(10, 99)}") for _ in range(60)]
    docs = spark.createDataFrame([(k, f"Taxes were paid late. {texts[k]} The barn was burned.") for k in range(0, 60, 6)], "doc_id long, text string")

    def leaked(copies):
        items = spark.createDataFrame([(100 * c + k, t) for c in range(copies) for k, t in enumerate(texts)], "item_id long, item_text string")
        return {(r["doc"], r["item"]) for r in find_leaks(docs, "doc_id", "text", items, "item_id", "item_text").collect()}

    once = leaked(1)
    assert once >= {(k, k) for k in range(0, 60, 6)} and leaked(4) == {(d, 100 * c + i) for c in range(4) for d, i in once}
    monkeypatch.setattr(leaks, "BLOCK_ITEMS", 100)
    assert leaked(4) >= {(k, 100 * c + k) for c in range(4) for k in range(0, 60, 6)}


def test_a_passage_that_many_items_share_has_seeds(spark):
    # Twelve different items quote one passage, so its words and neighbours are too common to be seeds of that kind.
    passage = "to repair the transmission line on notice of 42 days the south boundary of it runs S 16 34 E for about 2135.5 feet and then leaves the road"
    docs = [(1, f"Taxes were paid late because the notice had been sent to an old box. {passage}. The barn was burned."), (2, passage.replace("42", "9").replace("16 34", "8 7").replace("2135.5", "12.25"))]
    items = [(i, f"The owner of tract {700 + i} has the right {passage} to the north.") for i in range(60, 72)]
    found = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", spark.createDataFrame(items, "item_id long, item_text string"), "item_id", "item_text")
    assert {(r["doc"], r["item"]) for r in found.collect()} == {(1, i) for i in range(60, 72)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh12"), min_size=23, max_size=40), st.lists(st.integers(0, 39), max_size=12))
def test_shared_words_refuse_no_leak(item, changed):
    known = leaks.Items([(1, " ".join(item))])
    own = known.own[0]
    doc = [("x" if i in changed else t) for i, t in enumerate(item)]
    if leaks.leaked(item, own, doc)[0] >= leaks.LEAST_WORDS - leaks.EDGE:
        assert leaks._may_leak(item, own, set(doc)) and leaks._own_met(known.own_words[0], known.need(0), set(doc))


def test_a_passage_outlasts_stray_chains():
    item = [f"p{i}" for i in range(40)] + [f"q{i}" for i in range(80)]
    doc = []
    for m in range(20):
        doc += [f"p{2 * m}", f"p{2 * m + 1}"] + ([f"q{78 - 3 * m}", f"q{79 - 3 * m}"] if m < 19 else [])
    assert leaks.leaked(item, np.array([i < 40 for i in range(120)]), doc)[0] == 40


TRAIN = {
    "en": ["the owner of the parcel says that the barn was burned", "please find the survey plat of the land enclosed with this letter", "the exemption for the parcel lapsed because the form was not returned"],
    "es": ["el dueño de la parcela dice que el granero quedó destruido", "la oficina envió el aviso pero la familia ya no vive allí", "los herederos quieren dividir las tierras en partes iguales"],
    "de": ["der eigentümer des grundstücks sagt dass die scheune zerstört worden ist", "das amt schickte den bescheid aber die familie wohnt nicht mehr dort", "die erben möchten das land zu gleichen teilen aufteilen"],
}


def test_language_held_out_and_segments(spark):
    rng = np.random.default_rng(3)
    make = lambda k: " ".join(rng.permutation(" ".join(TRAIN[k]).split())[:14])
    texts = [(k, make(k)) for _ in range(80) for k in TRAIN]
    model = language.fit([language.words(t) for _, t in texts[:200]], [k for k, _ in texts[:200]])
    lang, conf = language.Tagger(model).tag([language.words(t) for _, t in texts[200:]])
    assert np.mean([model.languages[i] == k for i, (k, _) in zip(lang, texts[200:])]) > 0.95 and conf.max() <= 1
    two = f"{TRAIN['en'][0].capitalize()}. {TRAIN['en'][1].capitalize()}.\n\nLOT 7 BLK 9 AC 2.37\n\n{TRAIN['es'][0].capitalize()}."
    rows = [(i, t, k if i % 9 else "de") for i, (k, t) in enumerate(texts)] + [(900, two, "English"), (901, "", "en"), (902, None, "en"), (903, "LOT 7 BLK 9", "en"), (904, texts[0][1], None), (905, texts[0][1], "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {}
    for r in language.tag_documents(df, "doc_id", "text", "lang").collect():
        got.setdefault(r["doc"], []).append((r["seg_no"], r["lang"], r["label_lang"]))
    assert sorted(got[900]) == [(0, "en", "en"), (1, "es", "en")] and not {901, 902, 903} & set(got)
    assert got[904][0][2] is None and got[905][0][2] is None
    assert language.tag_documents(df.limit(0), "doc_id", "text", "lang").count() == 0


@pytest.mark.parametrize(("label", "code"), [("EN", "en"), ("en-US", "en"), ("es_MX", "es"), ("Español", "es"), ("fra", "fr"), ("xx", None), ("und", None), ("", None), (None, None), ("unknown", None), ("N/A", None)])
def test_labels(label, code):
    assert language.label_language(label) == code


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.floats(0, 1)), max_size=80))
def test_pack_keeps_limits_and_places_all(sizes):
    tokens_ = np.array([s for s, _ in sizes], np.int64)
    loss = np.array([int(s * f) for s, f in sizes], np.int64)
    box = packing.pack(tokens_, loss, (100, 4, 90)) if not len(loss) or loss.max() <= 90 else None
    if box is None or not len(box):
        return
    assert (box >= 0).all() and np.bincount(box, tokens_).max() <= 100 and np.bincount(box).max() <= 4 and np.bincount(box, loss).max() <= 90


def test_fill_containers(spark):
    rows = [(i, 0, 0, 30 + (i * 37) % 400, (i * 37) % 300) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "doc long, piece_no int, start_token int, n_tokens int, n_loss int")
    out = packing.fill_containers(pieces, shard=900).toPandas()
    sums = out.groupby("container_id").agg(t=("n_tokens", "sum"), s=("doc", "count"), b=("n_loss", "sum"), last=("position", "max"))
    assert sorted(out["doc"]) == list(range(3000)) and sums["t"].max() <= packing.TOKENS and sums["s"].max() <= packing.SEGMENTS and sums["b"].max() <= packing.LOSS
    assert (sums["last"] == sums["s"] - 1).all() and sums["t"].sum() / (len(sums) * packing.TOKENS) > 0.97
    assert packing.fill_containers(pieces.limit(0)).count() == 0


def test_measure_splits_only_long_texts(spark):
    df = spark.createDataFrame([(1, "Short text. More of it."), (2, "word " * 9000), (3, ""), (4, None)], "doc_id long, text string")
    rows = packing.measure(df, "doc_id", "text").orderBy("doc", "piece_no").collect()
    assert [r["doc"] for r in rows].count(1) == 1 and {r["doc"] for r in rows} == {1, 2}
    long = [r for r in rows if r["doc"] == 2]
    total = len(packing.tokenizer("/opt/tokenizers/byte_bpe_50k.tiktoken").encode_ordinary("word " * 9000))
    assert sum(r["n_tokens"] for r in long) == total and all(r["n_tokens"] <= packing.TOKENS and r["n_loss"] <= packing.LOSS for r in long)
    assert leaks.LEAST_WORDS == 25


def test_measure_keeps_a_text_of_one_container_whole(spark):
    encode = packing.tokenizer("/opt/tokenizers/byte_bpe_50k.tiktoken").encode_ordinary
    text = "Go." + " a" * 2036
    n = len(encode(text))
    assert packing.LOSS + 2 < n <= packing.TOKENS
    pieces = packing.measure(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text")
    assert [tuple(r) for r in pieces.collect()] == [(1, 0, 0, n, packing.LOSS)]
    assert packing.fill_containers(pieces).count() == 1
