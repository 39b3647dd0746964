import pytest

from ordstrata.llm import pii
from ordstrata.llm.common import Cache

PHONES = [f"(312)555-{i:04d}" for i in range(100, 160)]
SPACED = [f"(312) 555-{i:04d}" for i in range(100, 160)]


@pytest.mark.parametrize("between", [",", ";", " ", ", "])
@pytest.mark.parametrize("phones", [PHONES, SPACED])
def test_no_stretch_ends_inside_a_number_of_a_list(between, phones):
    text = "id,phone," + between.join(phones)
    places, at = [], 0
    for phone in phones:
        at = text.index(phone, at)
        places.append((at, at + len(phone)))
        at += len(phone)
    found = pii.islands(text)
    for a, b in places:
        assert any(start <= a and b <= start + len(x) for start, x in found)


def test_lists_are_found_whole():
    field = pii.SpanField().fit(pii.labelled_table() * 2)
    decoded = Cache(field.decode)
    for phones, between in ((PHONES, ","), (PHONES, " "), (SPACED, " "), (SPACED, ", ")):
        alone = {p: pii.all_spans(p, decoded)[1] for p in phones}
        assert all(len(spans) == 1 for spans in alone.values())
        text = "phones: " + between.join(phones)
        spans = pii.all_spans(text, decoded)[1]
        assert len(spans) == len(phones)
        for phone, (a, _, b) in zip(phones, spans):
            assert phone in text[a:b] and b - a <= len(phone) + len(between)


def test_a_long_list_is_searched_in_linear_memory():
    text = ",".join(PHONES * 50)
    field = pii.SpanField().fit(pii.labelled_table())
    assert len(pii.all_spans(text, Cache(field.decode))[1]) == len(PHONES) * 50
