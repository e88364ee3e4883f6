from townlens.functions.dom import parse
from townlens.operators import page_contacts as p


def test_lines_without_signs_of_an_address_are_not_searched(monkeypatch):
    assert p.emails_in("jane (at) t (dot) org, [ AT ]") == ["jane@t.org"]
    assert p.emails_in("jane at] t.org") == p.emails_in("jane&#64;t.org") == ["jane@t.org"]
    monkeypatch.setattr(p, "EMAIL_RE", None)
    assert p.emails_in("at the hall, Monday") == p.emails_in("(Monday)") == p.emails_in("") == []


def test_links_are_read_only_in_lines_of_people(monkeypatch):
    monkeypatch.setattr(p, "links_of", None)
    assert p.from_inline(parse("<p>Open on Monday</p><ul><li>Jane Doe, Clerk - 203-555-0101</li></ul>")) == []


def test_walk_is_the_order_of_the_document():
    root = parse("a<div>b<p>c<b>d</b></p><br>e</div><i>f</i>")
    assert [x.tag for x in root.walk()] == ["html", "div", "p", "b", "br", "i"]
    assert [x.marks for x in parse("<p><b id='X' class='Y'>").walk()] == [" ", " ", "y x"]
