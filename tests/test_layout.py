import pytest

from readloom.plans.layout import Span, compile_layout, compile_side, parse_layout


def test_named_layouts():
    left = parse_layout("iclip").left
    assert (left.size, left.random, left.index, left.code) == (9, (0, 1, 2, 7, 8), Span(3, 7), None)
    both = parse_layout("uvCLAP")
    assert (both.left.size, both.left.random, both.left.index) == (10, (0, 1, 2, 8, 9), Span(3, 8))
    assert (both.right.random, both.right.code) == ((4,), Span(0, 4))
    assert (both.right.code_pattern("A"), both.right.code_pattern("B")) == ("^[CT][AG][AG][CT]$", "^[AG][CT][CT][AG]$")
    assert len(both.right.codes("A")) == 16 and both.umi_size == 10
    right = parse_layout("flash").right
    assert (right.size, right.random, right.index, right.code) == (13, (0, 1, 4, 11, 12), Span(5, 11), Span(2, 4))
    assert sorted(right.codes("A")) == ["AA", "AG", "GA", "GG"] and sorted(right.codes("B")) == ["CC", "CT", "TC", "TT"]
    assert sorted(parse_layout("flash_v1").right.codes("A")) == ["CC", "CT", "TC", "TT"]
    assert parse_layout("flash").umi_size == 7 and parse_layout("iclip").umi_size == 5


def test_own_layouts():
    assert parse_layout("r=nnxxx, L=NN").right.index == Span(2, 5)
    assert parse_layout("L=NXX").right.size == 0
    assert compile_side("NXXN").random_runs() == [Span(0, 1), Span(3, 4)]
    assert compile_side("XX").trimmed == 0 and compile_side("XXN").trimmed == 3


@pytest.mark.parametrize("bad", ["L=NZ", "Q=NN", "", "flush"])
def test_refused(bad):
    with pytest.raises(ValueError):
        parse_layout(bad)


def test_refused_sides():
    for pair in (("XNX", ""), ("RNYX", ""), ("", ""), ("NN", "NN")):
        with pytest.raises(ValueError):
            compile_layout(*pair)
