"""Files in and out."""

import pytest
from pyspark.sql import functions as F

from reachmap.functions import geom as G
from reachmap.plans import products
from reachmap.sinks import writers
from reachmap.sources import fixtures as fx, readers
from reachmap.sources.schemas import GEOM, TRACT_AREA

from .helpers import square


def test_filings_csv_keeps_zeros_and_reads_six_columns(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text(
        "Provider,Census Block FIPS Code,Holding Company Number,Technology Code,Consumer,"
        "Max Advertised Downstream Speed (mbps),Max Advertised Upstream Speed (mbps)\n"
        "x,010010000010001,130077,50,1,30.5,\n"
    )
    df = readers.read_filings(spark, str(path))
    assert df.first().asDict() == {
        "block_code": "010010000010001", "consumer": 1, "hoconum": 130077, "tech_code": 50,
        "max_ad_down": 30.5, "max_ad_up": None,
    }


def test_filings_are_read_by_name_and_bad_numbers_fail(spark, tmp_path):
    head = (
        "Consumer,Max Advertised Upstream Speed (mbps),Technology Code,Census Block FIPS Code,"
        "Max Advertised Downstream Speed (mbps),Holding Company Number\n"
    )
    (tmp_path / "a.csv").write_text(head + "1,2.5,,10010000010001, 30 ,130077.0\n")
    assert readers.read_filings(spark, str(tmp_path / "a.csv")).first().asDict() == {
        "block_code": "010010000010001", "consumer": 1, "hoconum": 130077, "tech_code": None,
        "max_ad_down": 30.0, "max_ad_up": 2.5,
    }
    (tmp_path / "b.csv").write_text(head + "1,2.5,50,010010000010001,30,many\n")
    with pytest.raises(Exception, match="many"):
        readers.read_filings(spark, str(tmp_path / "b.csv")).collect()
    (tmp_path / "c.csv").write_text(head.replace("Consumer", "Buyer") + "1,2.5,50,1,30,1\n")
    with pytest.raises(ValueError, match="Consumer"):
        readers.read_filings(spark, str(tmp_path / "c.csv"))


def test_auxiliary_files(spark, tmp_path):
    (tmp_path / "p.csv").write_text("pop2016,block_fips,hu2016\n7,010010000010001,3\n")
    assert readers.read_block_hu_pop(spark, str(tmp_path / "p.csv")).first().asDict() == {
        "block_fips": "010010000010001", "hu2016": 3, "pop2016": 7,
    }
    fields = TRACT_AREA.split(",") if isinstance(TRACT_AREA, str) else [f.name for f in TRACT_AREA]
    names = [f.split()[0] for f in fields]
    (tmp_path / "t.csv").write_text("area," + names[0] + "\n2.5,01001000001\n")
    row = readers.read_tract_area(spark, str(tmp_path / "t.csv")).first()
    assert (row[names[0]], row["area"]) == ("01001000001", 2.5)


def test_quoted_pipe_file(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_text("block_fips|x_zoom|y_zoom\n'010010000010001'|5|\n")
    assert tuple(readers.read_large_blocks(spark, str(path)).first()) == ("010010000010001", 5, None)


def test_geojson_collection(spark, tmp_path):
    path = tmp_path / "f.geojson"
    path.write_text(
        '{ "type": "FeatureCollection",\n"features": [\n'
        '{ "type": "Feature", "properties": { "id": "01" }, "geometry": { "type": "Polygon", '
        '"coordinates": [ [ [0,0],[2,0],[2,2],[0,2],[0,0] ] ] } },\n'
        '{ "type": "Feature", "properties": { "id": "02" }, "geometry": { "type": "MultiPolygon", '
        '"coordinates": [ [ [ [0,0],[1,0],[1,1],[0,0] ] ] ] } }\n]\n}\n'
    )
    df = readers.read_geojson(spark, str(path), "id: string")
    got = {r.id: r.a for r in df.select("id", G.area(F.col("geom")).alias("a")).collect()}
    assert got == {"01": 4.0, "02": 0.5}


def test_geojson_on_one_line_and_other_geometries(spark, tmp_path):
    square_ = '{"type": "Polygon", "coordinates": [[[0,0],[2,0],[2,2],[0,2],[0,0]]]}'
    feature = '{"type": "Feature", "properties": {"id": "%s"}, "geometry": %s}'
    line = '{"type": "FeatureCollection", "features": [%s, %s]}'
    (tmp_path / "one").write_text(line % (feature % ("01", square_), feature % ("02", "null")))
    got = {r.id: r.geom for r in readers.read_geojson(spark, str(tmp_path / "one"), "id: string").collect()}
    assert set(got) == {"01", "02"} and got["02"] is None and len(got["01"][0][0]) == 5
    (tmp_path / "two").write_text(feature % ("03", '{"type": "Point", "coordinates": [1, 2]}'))
    with pytest.raises(Exception, match="Point"):
        readers.read_geojson(spark, str(tmp_path / "two"), "id: string").collect()


def pretty(n, indent=2, head=True):
    import json

    features = [
        {"type": "Feature", "properties": {"id": f"{i:03d} \" {{[", "more": [{"a": 1}, {"b": [2]}]},
         "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 2, 0], [i + 2, 2], [i, 2], [i, 0]]]}}
        for i in range(n)
    ]
    crs = {"type": "name", "properties": {"name": "x"}}
    if head:
        return json.dumps({"type": "FeatureCollection", "crs": crs, "links": [{"type": "link"}], "features": features}, indent=indent)
    return "\n".join(json.dumps(f, indent=indent) for f in features)


@pytest.mark.parametrize("head", [True, False])
@pytest.mark.parametrize("piece", [300, 5000, 10**8])
def test_geojson_that_spans_lines_is_read_in_many_tasks(spark, tmp_path, piece, head):
    (tmp_path / "a.geojson").write_text(pretty(40, head=head))
    (tmp_path / "b.geojson").write_text(pretty(3, indent=1, head=head).replace("},\n {", "}, {").replace("},\n  {", "}, {"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        rows = readers.read_geojson(spark, str(tmp_path), "id: string").select("id", G.area(F.col("geom")).alias("a")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = sorted(f'{i:03d} " {{[' for n in (40, 3) for i in range(n))
    assert sorted(r.id for r in rows) == want and {r.a for r in rows} == {4.0}


@pytest.mark.parametrize(
    "text",
    [
        '{"type": "Feature", "properties": {"id": "1"}, "geome',
        '{"type": "Feature", "properties": {"id": "1"}, "geometry": null}\n{"type": "Feature", "prop\n'
        '{"type": "Feature", "properties": {"id": "2"}, "geometry": null}',
        "what is this\n",
        '{"type": "Feature", "properties": {"id" "1"}, "geometry": null}\n',
        '{"type": "FeatureCollection",\n"features": [\n{"type": "Feature", "properties": {"id": 1,,}, "geometry": null}\n]}',
        '{\n"type": "Feature",\n"properties": {"id": "1}\n}',
        '{\n"type": "Feature", "properties": {"id": "1"}, "geometry": null\n}\nstray {\n}',
    ],
)
def test_geojson_that_is_broken_is_an_error(spark, tmp_path, text):
    (tmp_path / "x.geojson").write_text(text)
    with pytest.raises(Exception, match="x.geojson"):
        readers.read_geojson(spark, str(tmp_path), "id: string").count()


def test_geojson_is_in_key_order(spark, tmp_path):
    rows = [(f"{i:03d}", square(i, 0)) for i in range(50)]
    df = spark.createDataFrame(rows[::-1], "id string, geom " + GEOM.simpleString())
    writers.write_geojson(df, str(tmp_path / "g"), ["id"], ["id"], compression="gzip")
    back = readers.read_geojson(spark, str(tmp_path / "g"), "id: string")
    assert sorted(r.id for r in back.collect()) == [r[0] for r in rows]
    import gzip

    files = sorted((tmp_path / "g").glob("part-*.gz"))
    lines = [line for f in files for line in gzip.open(f, "rt")]
    assert [line.split('"id":"')[1][:3] for line in lines] == [r[0] for r in rows]


def test_release(spark, sf_dir, tmp_path):
    """All products of a release, with the exports readable again."""
    out = str(tmp_path / "release")
    f, b = fx.filings(spark, sf_dir), fx.blocks(spark, sf_dir)
    stats = products.statistics(f, b, out)
    products.exports(stats, out)
    made = products.shapes(
        f, fx.block_geom(spark, sf_dir, lonlat=True), fx.block_hu_pop(spark, sf_dir),
        fx.large_blocks(spark, sf_dir), out, threshold=3e6, pack_edges=12,
    )
    assert not made["long_outlines"].isEmpty()
    products.export_shapes(made, out, threshold=3e6)
    products.export_carto(fx.carto_tract(spark, sf_dir), fx.extra_tract(spark, sf_dir), fx.carto_county(spark, sf_dir), made, out, fx.ISLANDS)
    n = {name: readers.read_geojson(spark, f"{out}/geojson/{name}", "x: string").count() for name in (
        "xl_blocks", "bigtract_blocks", "big_tracts", "notbig_tracts", "large_footprints", "other_footprints", "carto_tracts", "carto_counties")}
    assert n["xl_blocks"] == made["xl_blocks"].count() and n["bigtract_blocks"] == made["bigtract_blocks"].count()
    whole = made["features"].filter("level = 'tract'").count()
    assert n["big_tracts"] + n["notbig_tracts"] == whole and n["carto_tracts"] > 0 and n["carto_counties"] > 0
    feet = made["footprint_outlines"].select("hoconum", "county_fips").distinct().count()
    assert n["large_footprints"] + n["other_footprints"] == feet
    base = products.base_map(made["features"].filter("level = 'county'"), out, {"county": (0, 6)}, budget=3)
    assert {r.z for r in base.select("z").distinct().collect()} == set(range(7))
    assert base.groupBy("z", "x", "y").count().filter("count > 3").isEmpty()
    made["pieces"] = products.map_pieces(made, out, threshold=3e6)
    assert {r.z for r in made["pieces"].select("z").distinct().collect()} == set(range(15))
    tile_table = products.map_tiles(stats, made, out, tiers=products.TIERS[3:4], threshold=3e6)
    rings = products.map_rings(made, out, threshold=3e6)
    assert {r.z for r in rings.select("z").distinct().collect()} == set(range(15))
    tracts = {r[0] for r in made["tract_outlines"].select("tract_id").distinct().collect()}
    at_eight = rings.filter("level = 'tract' and z = 8").select("feature_id").distinct()
    assert {r[0] for r in at_eight.collect()} == tracts  # however long their outlines
    dropped = tile_table.filter("layer = '25_3' and (feature_id is null) != (z < 11)")
    assert dropped.isEmpty()
    from reachmap.operators import area, numprov, rollup

    direct = area.area_table(f, b)
    assert direct.exceptAll(stats["area_table"].select(direct.columns)).isEmpty()
    means = rollup.weighted_numprov(f, b, 11, "tract_id")
    assert means.exceptAll(stats["tract_numprov"].select(means.columns)).isEmpty()
    names = products.combo_layout()
    back = readers.read_numprov_dir(spark, f"{out}/csv/block_numprov_with0", names)
    counts = numprov.block_numprov_long(f, b)
    assert back.count() * len(names) == counts.count()
    levels = {(r.layer, r.z) for r in tile_table.select("layer", "z").distinct().collect()}
    assert {z for layer, z in levels if layer == "25_3"} == set(range(15))
