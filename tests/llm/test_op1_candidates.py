"""The test before a pattern of candidates drops no text that has one."""

import pytest

from tessera.llm import pii


@pytest.mark.parametrize("address", ["jane.doe [At] example [Dot] com", "JANE [AT ] EX.COM", "jo.doe ( aT ) example (DOT) org", "jo[\tat]ex.com", "jo.doe [at] example [dot] com"])
def test_spelled_addresses_are_found_whatever_else_the_text_has(address):
    for text in (f"so write to {address} soon", f"(and that) then write to {address} soon"):
        assert [(text[s:e], k) for s, e, k, _ in pii.candidates(text, [])] == [(address, "email_words")]


def test_redacts_mixed_case_addresses(docs):
    rows = [(i, f"please mail jo.doe{i} [At] example [Dot] com about it") for i in range(30)]
    assert all("example" not in r["text"] for r in pii.redact(docs(rows)).collect())
