"""License texts as they stand in files: on one line, wrapped, between prose."""

from __future__ import annotations

import textwrap

from ledgermill.llm import licenses

PROSE = "The harbour was quiet that evening. Nobody had seen the boats come in."


def test_every_text_is_found_as_it_stands_and_wrapped(spark):
    forms = {
        "verbatim": lambda t: t,
        "wrapped": lambda t: textwrap.fill(t, 76),
        "between prose": lambda t: f"{PROSE}\nCopyright 2019 Some Holder.\n{textwrap.fill(t, 76)}\n{PROSE}",
    }
    cases = [(name, form, make(text)) for name, text in licenses.TEXTS.items() for form, make in forms.items()]
    docs = spark.createDataFrame([(i, c[2]) for i, c in enumerate(cases)] + [(len(cases), PROSE)], "doc_id bigint, text string")
    found = {r.doc_id: [m.name for m in r.matches] for r in licenses.scan(docs.coalesce(1)).collect()}
    assert found.pop(len(cases)) == []
    assert {cases[i][:2]: names for i, names in found.items()} == {c[:2]: [c[0]] for c in cases}
