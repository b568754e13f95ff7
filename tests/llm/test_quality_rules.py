"""Quality rules against a plain version."""

import random
import re
from collections import Counter

from helpers import LONG, clashing, documents, rows

from hitledger.llm import queries, quality_rules
from hitledger.llm.quality_rules import Rule


def statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_stop_words": sum(w.lower() in quality_rules.STOP_WORDS for w in words),
        "n_upper_words": sum(bool(re.search("[A-Z]{2}", w) and not re.search("[a-z]", w)) for w in words),
    }


def verdict(text, rules=quality_rules.RULES):
    found = statistics(text)
    n = found["n_words"]
    failed = n < 50 or 100 * found["n_repeat_words"] > 50 * n
    kept = [
        found[r.whole] == 0
        or (r.least is None or 100 * found[r.part] >= r.least * found[r.whole])
        and (r.most is None or 100 * found[r.part] <= r.most * found[r.whole])
        for r in rules
    ]
    return (*found.values(), failed, *kept, not failed and all(kept))


def check(docs, rules=quality_rules.RULES):
    judged = quality_rules.judged(docs, ["doc_id", "text"], rules)
    found = rows(judged.select("doc_id", "text", "quality.*"))
    expected = [(r.doc_id, r.text, *verdict(r.text, rules)) for r in docs.collect()]
    assert found == sorted(expected, key=repr)


def test_odd_rows(spark):
    check(clashing(documents(spark)))


def test_random_texts(spark):
    """Few words, so that windows overlap, repeat and touch in all ways."""
    draw = random.Random(3)
    texts = []
    for i in range(300):
        some = ["the", "a", "B#", "CD", "é|", "de", "<x>", "\U0001f389"][: 2 + i % 7]
        gaps = [" ", "\n", "\t ", "  ", "\n\n"]
        texts.append("".join(draw.choice(some) + draw.choice(gaps) for _ in range(draw.randrange(120))))
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_bounds_are_kept_and_hold_for_any_table_of_rules(spark):
    text = "ab# " * 1 + " ".join(f"word{i}" for i in range(99))
    docs = spark.createDataFrame([(1, text), (2, text + " #"), (3, LONG)], "doc_id long, text string")
    for rules in ([], [Rule("s", "n_symbols", "n_words", most=1)], [Rule("s", "n_symbols", "n_lines", least=200)]):
        check(docs, rules)
    assert [r.doc_id for r in quality_rules.filtered(docs, [Rule("s", "n_symbols", "n_words", 1, 1)]).collect()] == [1]


def test_columns_of_the_input_stay(spark):
    docs = clashing(documents(spark)).withColumnsRenamed({"lang": "n_words", "source": "quality"})
    judged = quality_rules.judged(docs, docs.columns)
    assert judged.columns == [*docs.columns, "_quality"]
    kept = quality_rules.filtered(docs)
    assert kept.columns == docs.columns
    wanted = [r for r in docs.collect() if verdict(r.text)[-1]]
    assert rows(kept) == sorted(map(tuple, wanted), key=repr)


def test_empty_table_and_plan(spark):
    docs = documents(spark)
    judged = quality_rules.judged(docs.where("false"), ["doc_id"])
    assert judged.count() == 0
    plan = queries.op11_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
