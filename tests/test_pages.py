"""Page extraction (X1-X6) and trace A on invented HTML fixtures (FIXTURES.md §4)."""

from tessera.operators import enrich, lookup
from tessera.plans import collect, etl
from tessera.sources import pages as P

BASE = "https://dex.example"
LISTING = f"{BASE}/list"

LISTING_HTML = """<html><body><table id="pokedex"><thead><tr><th>#</th><th>Name</th></tr></thead><tbody>
<tr><td class="cell-num">1</td><td class="cell-name"><a class="ent-name" href="/p/aqualo">Aqualo</a></td></tr>
<tr><td class="cell-name"><a class="ent-name" href="/p/volto">Volto</a><br><small class="text-muted">Wash Volto</small></td></tr>
<tr><td class="cell-name">No link</td></tr>
<tr><td class="cell-name"><a class="ent-name" href="/p/aqualo">Aqualo</a></td></tr>
</tbody></table></body></html>"""

AQUALO_HTML = """<html><body><main><h1>Aqualo</h1>
<h2>Pokédex data</h2>
<table class="vitals-table"><tbody>
<tr><th>National №</th><td><strong>0007</strong></td></tr>
<tr><th>Type</th><td><a class="type-icon">Water</a></td></tr>
<tr><th>Height</th><td>0.5 m (1′08″)</td></tr>
<tr><th>Weight</th><td>9.0 kg (19.8 lbs)</td></tr>
<tr><th>Abilities</th><td><span><a href="/ability/surge">Surge</a></span>
<small><a href="/ability/rain-cup">Rain Cup</a> (hidden)</small></td></tr>
</tbody></table>
<h2>Type defenses</h2>
<div><table class="type-table type-table-pokedex">
<tr><th><a title="Normal type">Normal</a></th><th><a title="Fire type"></a></th><th><img alt="Water type"></th><th class="cell-total">T</th></tr>
<tr><td>1</td><td>½</td><td></td><td>x</td></tr></table></div>
<h2>Evolution chart</h2>
<div class="infocard-list-evo">
<div class="infocard"><span><small>#0007</small><a class="ent-name" href="/p/aqualo">Aqualo</a><small><a class="itype water">Water</a></small></span></div>
<span class="infocard-arrow"><small>(Level 16)</small></span>
<div class="infocard"><small>#0008</small><a class="ent-name" href="/p/aqualor">Aqualor</a></div>
<span class="infocard-arrow"><small>(Level 36)</small></span>
<div class="infocard"><small>#0009</small><a class="ent-name" href="/p/aquamax">Aquamax</a></div>
</div></main></body></html>"""

VOLTO_HTML = """<html><body><h1>Volto</h1>
<div><h2>Volto</h2><table class="vitals-table"><tr><th>National №</th><td><strong>0479</strong></td></tr>
<tr><th>Type</th><td><a>Electric</a> <a>Ghost</a></td></tr></table>
<h2>Pokédex data <small>Wash Volto</small></h2><table class="vitals-table"><tr><th>National №</th><td><strong>0479</strong></td></tr>
<tr><th>Type</th><td><a>Electric</a> <a>Water</a></td></tr><tr><th>Height</th><td>0.3 m</td></tr></table></div>
</body></html>"""

SURGE_HTML = """<html><body><main><h2>Effect</h2><p>Powers up <b>Water</b>-type moves</p><p>in a pinch.</p>
<h2>Other</h2><p>ignored</p></main></body></html>"""

GAME_ONLY_HTML = """<html><body><h2>Game descriptions</h2><div><table class="vitals-table">
<tr><th>Red</th><td>Old   text</td></tr></table></div></body></html>"""

UNCLOSED_HTML = """<html><body><article><h1>T &amp; U</h1><p><b>First &copy; para<br><p>Second.</p></article></body></html>"""


def _pages(spark):
    rows = [(LISTING, LISTING_HTML), (f"{BASE}/p/aqualo", AQUALO_HTML), (f"{BASE}/p/volto", VOLTO_HTML),
            (f"{BASE}/ability/surge", SURGE_HTML), (f"{BASE}/ability/game", GAME_ONLY_HTML),
            (f"{BASE}/x/unclosed", UNCLOSED_HTML)]
    return spark.createDataFrame(rows, "url string, html string")


def test_parser_handles_unclosed_paragraphs():
    root = P.parse_html(UNCLOSED_HTML)
    assert P.first_h1_text(root) == "T & U"
    assert P.description_candidates(root) == ["", "", "First © para", ""]


def test_extractors_on_fixtures():
    sq = P.parse_html(AQUALO_HTML)
    t = P.vitals_tables(sq)
    assert len(t) == 1 and t[0]["label"] == "Pokédex data" and t[0]["numero"] == "0007"
    assert (t[0]["tamanho"], t[0]["peso"], t[0]["tipos"]) == ("0.5 m (1′08″)", "9.0 kg (19.8 lbs)", ["Water"])
    assert t[0]["hab_nomes"] == ["Surge", "Rain Cup"]
    assert P.effectiveness(sq) == (["Normal", "Fire", "Water"], ["1", "½", "", "x"])
    evo = P.evolution_cards(sq)
    assert [(e["small"], e["nome"]) for e in evo] == [("#0007", "Aqualo"), ("(Level 16)", None),
                                                     ("#0008", "Aqualor"), ("(Level 36)", None),
                                                     ("#0009", "Aquamax")]
    ro = P.vitals_tables(P.parse_html(VOLTO_HTML))
    assert [x["label"] for x in ro] == ["Volto", "Wash Volto"]
    assert P.description_candidates(P.parse_html(SURGE_HTML))[0].split() == \
        "Powers up Water -type moves in a pinch.".split()
    assert P.description_candidates(P.parse_html(GAME_ONLY_HTML))[3] == "Old   text"
    rows = P.listing_rows(P.parse_html(LISTING_HTML))
    assert [(r["href"], r["form_hint"]) for r in rows] == [
        ("/p/aqualo", "Base"), ("/p/volto", "Wash Volto"), (None, "Base"), ("/p/aqualo", "Base")]


def test_collect_items_trace_a(spark):
    items = collect.collect_items(_pages(spark), LISTING)
    got = {r["seq"]: r.asDict(recursive=True) for r in items.collect()}
    assert sorted(got) == [0, 1, 3]        # the row without a link is skipped; repeats are kept
    sq = got[0]
    assert (sq["numero"], sq["nome"], sq["tipos"]) == ("0007", "Aqualo", "Water")
    assert sq["efetividade"] == {"Normal": "1", "Fire": "½", "Water": "1"}
    assert sq["habilidades"] == [
        {"url": f"{BASE}/ability/surge", "nome": "Surge", "descricao": "Powers up Water -type moves in a pinch."},
        {"url": f"{BASE}/ability/rain-cup", "nome": "Rain Cup", "descricao": enrich.MISSING_PAGE_TEXT}]
    assert sq["proximas_evolucoes"] == [
        {"numero": "#0008", "level": "Level 36", "item": None, "nome": "Aqualor", "url": f"{BASE}/p/aqualor"},
        {"numero": "#0009", "level": None, "item": None, "nome": "Aquamax", "url": f"{BASE}/p/aquamax"}]
    ro = got[1]
    # the hint 'Wash Volto' contains the first table's label 'Volto' (containment both ways)
    assert (ro["numero"], ro["tipos"], ro["habilidades"], ro["proximas_evolucoes"]) == \
        ("0479", "Electric, Ghost", [], [])


def test_trace_a_to_d(spark):
    raw = collect.items_as_raw_text(collect.collect_items(_pages(spark), LISTING))
    docs = etl.load_collection(etl.build_documents(etl.clean_items(raw)))
    d = {r["numero"]: r.asDict(recursive=True) for r in docs.collect()}
    assert sorted(d) == [7, 479]
    sq = d[7]
    assert sq["altura_cm"] == 50.0 and sq["peso_kg"] == 9.0
    assert sq["efetividade"] == {"Normal": 1.0, "Fire": 0.5, "Water": 1.0}
    assert sq["evolucao"] == {"numero": 8, "nome": "Aqualor", "url": f"{BASE}/p/aqualor",
                              "condicao": {"level": 36, "item": None}}
    assert [h["nome"] for h in sq["habilidades"]] == ["Surge", "Rain Cup"]
    assert lookup.water_after_level(docs).count() == 1


TWO_CHAINS_HTML = """<html><body><h1>Beta</h1>
<div class="infocard-list-evo"><div><small>#0001</small><a class="ent-name" href="/p/a">Alpha</a></div>
<span><small>(Level 10)</small></span><div><small>#0002</small><a class="ent-name" href="/p/b">Beta</a></div></div>
<div class="infocard-list-evo"><div><small>#0003</small><a class="ent-name" href="/p/c">Gamma</a></div>
<span><small>(Level 30)</small></span><div><small>#0004</small><a class="ent-name" href="/p/d">Delta</a></div></div>
</body></html>"""


def _evolutions_of(spark, **kw):
    listing = """<table id="pokedex"><tbody><tr><td class="cell-name"><a class="ent-name" href="/p/b">B</a>
    </td></tr></tbody></table>"""
    pages = spark.createDataFrame([(LISTING, listing), (f"{BASE}/p/b", TWO_CHAINS_HTML)], "url string, html string")
    r = collect.collect_items(pages, LISTING, **kw).first()
    return [(e["numero"], e["nome"], e["level"]) for e in r["proximas_evolucoes"]]


def test_evolution_pairing_options(spark):
    # source behaviour: lists concatenated, an odd-length list flips the
    # alternation of the next one (H6); level = connector after the entry (H5)
    assert _evolutions_of(spark) == [("(Level 30)", None, "#0004")]
    assert _evolutions_of(spark, per_chain=True) == [("#0003", "Gamma", "Level 30"), ("#0004", "Delta", None)]
    assert _evolutions_of(spark, per_chain=True, incoming_level=True) == \
        [("#0003", "Gamma", None), ("#0004", "Delta", "Level 30")]


def test_deeply_nested_unclosed_tags():
    html = "<html><body><article><h1>Deep</h1><p>" + "<b>x" * 5000 + "</article></body></html>"
    root = P.parse_html(html)
    assert P.first_h1_text(root) == "Deep"
    assert P.description_candidates(root)[2] == " ".join(["x"] * 5000)


NO_TABLE_HTML = """<html><body><main><h1>Plain</h1>
<table class="type-table"><tr><th><a>Fire</a></th><th><a>Water</a></th><th><a>Ice</a></th></tr>
<tr><td>2</td></tr></table>
<div class="infocard-list-evo"><div><small>#0001</small><a class="ent-name" href="/p/a">Other</a></div>
<span><small>(Level 5)</small></span><div><small>#0002</small><a class="ent-name" href="/p/b">Else</a></div></div>
<p>Intro text</p></main></body></html>"""

LATE_EFFECT_HTML = """<html><body><h2>Effect</h2><h2>Notes</h2><p>Late paragraph.</p></body></html>"""
EMPTY_ABILITY_HTML = """<html><body><h2>Nothing here</h2></body></html>"""


def test_page_edge_cases():
    root = P.parse_html(NO_TABLE_HTML)
    assert P.vitals_tables(root) == []
    # fewer cells than headers: the map stops at the shorter list later (M1)
    assert P.effectiveness(root) == (["Fire", "Water", "Ice"], ["2"])
    assert P.description_candidates(P.parse_html(LATE_EFFECT_HTML))[:2] == ["", "Late paragraph."]
    assert P.description_candidates(P.parse_html(EMPTY_ABILITY_HTML)) == ["", "", "", ""]


def test_collect_edge_cases(spark):
    listing = f"""<table id="pokedex"><tbody>
    <tr><td class="cell-name"><a class="ent-name" href="/p/plain">Plain</a></td></tr>
    <tr><td class="cell-name"><a class="ent-name" href="/p/withab">W</a></td></tr></tbody></table>"""
    withab = """<html><body><h1>W</h1><h2>x</h2><table class="vitals-table">
    <tr><th>National №</th><td><strong>0042</strong></td></tr>
    <tr><th>Abilities</th><td><a href="/ability/late">Late</a> <a href="/ability/empty">Empty</a></td></tr></table>
    </body></html>"""
    pages = spark.createDataFrame([(LISTING, listing), (f"{BASE}/p/plain", NO_TABLE_HTML), (f"{BASE}/p/withab", withab),
                                   (f"{BASE}/ability/late", LATE_EFFECT_HTML),
                                   (f"{BASE}/ability/empty", EMPTY_ABILITY_HTML)], "url string, html string")
    got = {r["seq"]: r.asDict(recursive=True) for r in collect.collect_items(pages, LISTING).collect()}
    plain = got[0]
    # no vitals table: empty fields; current name absent from the chain: no successors
    assert (plain["numero"], plain["tamanho"], plain["tipos"], plain["habilidades"]) == ("", "", "", [])
    assert plain["proximas_evolucoes"] == [] and plain["efetividade"] == {"Fire": "2"}
    assert [h["descricao"] for h in got[1]["habilidades"]] == ["Late paragraph.", enrich.NO_DESCRIPTION_TEXT]
