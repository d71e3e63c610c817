"""Spans that the four patterns miss are added, learned from those they find."""

import random

from centstream.llm import pii


def corpus(n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        ip = ".".join(str(rng.randrange(256)) for _ in range(4))
        card = "".join(rng.choices("0123456789", k=15))
        card += next(d for d in "0123456789" if pii.luhn(card + d))
        phone = f"+{rng.randint(30, 59)} {rng.randint(100, 999)} {rng.randint(100, 999)} {rng.randint(10, 99)}"
        rows.append((i, f"write to me{i}@mail{i % 7}.com from {ip} pay {card} or call {phone} now"))
    return rows


PLANTED = {
    "email": ["anna (at) example.org", "bob[at]example[dot]net"],
    "ip": ["10[.]20[.]30[.]40", "192 . 168 . 1 . 77"],
    "phone": ["49 301 234 56", "0049 301 234 56"],
}
CLEAN = ["10[.]20[.]930[.]40", "on 2020-01-02 it", "bob[at]example[dot]7"]


def spans(spark, rows, model):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.spans for r in pii.scan(docs, model).collect()}


def test_forms_that_the_patterns_miss_are_added(spark):
    rows, at = corpus(), {}
    for kind, forms in PLANTED.items():
        for form in forms:
            at[len(rows)] = kind, form
            rows.append((len(rows), f"they said {form} to us"))
    clean = range(len(rows), len(rows) + len(CLEAN))
    rows += [(i, f"they said {form} to us") for i, form in zip(clean, CLEAN, strict=True)]
    model = pii.train(spark.createDataFrame(rows, "doc_id long, text string"))
    got = spans(spark, rows, model)
    for i, (kind, form) in at.items():
        assert got[i] == f"{kind}:10:{10 + len(form)}", (form, model.thresholds)
    assert [got[i] for i in clean] == [""] * len(CLEAN)


def test_a_rare_kind_has_a_threshold_beside_one_text_full_of_numbers(spark):
    rows = [(i, f"write to me{i}@mail{i % 7}.com now") for i in range(300)]
    rows += [(400 + i, f"from 10.{i * 7}.{i}.{250 - i} now") for i in range(30)]
    rows += [(500, " ".join(f"10.0.{i % 250}.{i % 199}" for i in range(10_000)))]
    rows += [(501 + i, f"call +49 {300 + i} {123 + i} 45{i % 10} now") for i in range(30)]
    model = pii.train(spark.createDataFrame(rows, "doc_id long, text string"), 4000)
    assert model.trees is not None
    assert all(model.thresholds[k] <= 1 for k in (0, 1, 3)), model.thresholds
