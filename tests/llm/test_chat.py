import pytest
from hypothesis import given
from hypothesis import strategies as st

from homestat.llm import chat
from homestat.llm import template as T


def render(source, messages):
    c = T.compile_template(source)
    out = T.Writer()
    c.head({}, out)
    for i, m in enumerate(messages):
        c.turn({"message": m, "loop": {"first": i == 0, "last": i == len(messages) - 1, "index0": i}}, out)
    c.tail({}, out)
    return "".join(out.parts), out.spans


def test_language():
    source = ("<s>{% for m in messages %}{% if loop.first and not (m.role == 'x') %}first {% elif m.role != \"x\" %}{{ loop.index0 }}"
              "{% else %}X{% endif %}{{ (m.role ~ ':' ~ m.text) | upper }}{% if not loop.last %}, {% endif %}{% endfor %}</s>")
    messages = [{"role": "a", "text": "t"}, {"role": "x", "text": "u"}, {"role": "b", "text": "v"}]
    assert render(source, messages)[0] == "<s>first A:T, XX:U, 2B:V</s>"


def test_constants_are_folded():
    body = T.fold_block(T.parse("{% for m in messages %}a{{ 'b' ~ 1 | trim }}{% if 'x' == 'y' or false %}{{ m.text }}{% else %}c{% endif %}{% endfor %}"))
    assert body == (T.Loop("m", (T.Emit(T.Const("ab1c")),)),)


@pytest.mark.parametrize("bad", [
    "x", "{% for m in messages %}", "{% for m in other %}{% endfor %}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}",
    "{% for m in messages %}{{ open('f') }}{% endfor %}", "{% for m in messages %}{{ m.text | eval }}{% endfor %}", "{{ m.text }}",
    "{% import os %}", "{% for m in messages %}{{ 'a }}{% endfor %}", "{% for m in messages %}" + "{% if true %}" * 60 + "{% endif %}" * 60 + "{% endfor %}"])
def test_what_is_not_in_the_language_is_refused(bad):
    with pytest.raises(T.TemplateError):
        T.compile_template(bad)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a>b\\"]), st.text(alphabet="\\<>/turn \n#é🙂x", max_size=30)), min_size=1, max_size=4))
def test_round_trip(turns):
    out, spans = render(chat.TEMPLATE, [{"role": r, "text": t} for r, t in turns])
    reader = chat.Reader(1)
    reader.read(out, [{"first": a, "end": b} for a, b in spans])
    import hashlib
    assert reader.row() == (1, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                            sum(len(t) for r, t in turns if r == "assistant"),
                            hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest(), len(out))


def test_pieces_and_extra_columns(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", "b", "x"), (1, 0, "user", "a", "y"), (None, 0, "user", None, "z")],
                                 "conv_id long, turn long, role string, text string, piece string")
    out = chat.format_conversations(rows).orderBy("conv_id", "piece").collect()
    assert [(r.conv_id, r.piece, r.text) for r in out] == [
        (None, 0, "<turn user>\n</turn>\n"), (1, 0, "<turn user>\na</turn>\n"), (1, 1, "<turn assistant>\nb</turn>\n")]
    whole = out[1].text + out[2].text
    assert [whole[s.first:s.end] for s in out[2].loss] == ["b"]
