"""Formulas, drawings and fallback text are text of their block."""

from chronofeat.llm.dom import parse


def test_formulas_and_fallback_text():
    page = ("<article><p>Then <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation encoding='TeX'>x</annotation></math> holds."
            "</p><object data='f'>A table of figures.</object><svg><path d='M0'/><text>Jan</text><text>Feb</text></svg>"
            "<canvas>A chart</canvas><script>no</script><template>no</template><style>no</style></article>")
    assert [t for _, t, _ in sorted(r for x in parse(page) for r in x.runs)] == ["Then x=12 holds.", "A table of figures. Jan Feb A chart"]
