import json

import pytest

from hourgrid.operators import geo
from hourgrid.sources import trips as SRC
from tests.rows import zones

SQUARE = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
FEATURES = [
    (1, "Polygon", [SQUARE]),
    (2, "Polygon", [SQUARE[::-1], [[0.5, 0.5], [1, 0.5], [1, 1]]]),  # clockwise, with a hole
    (3, "Polygon", [[[1, 1], [3, 3]]]),  # two points
    (4, "Polygon", [[[0, 0], [1, 1], [2, 2]]]),  # no area
    (5, "MultiPolygon", [[SQUARE], [[[10, 0], [11, 0], [11, 1], [10, 1], [10, 0]]]]),
    (77, "Polygon", [SQUARE]),
]


def collection(features):
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"LocationID": i, "zone": f"z{i}", "borough": "b"},
         "geometry": {"type": kind, "coordinates": c}} for i, kind, c in features
    ]})


@pytest.fixture(scope="module")
def features(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("geo")
    (folder / "zones.geojson").write_text(collection(FEATURES))
    return SRC.scan_geojson(spark, str(folder / "zones.geojson"))


def test_rings(features):
    rings = geo.exterior_rings(features)
    assert sorted((r.LocationID, r.ring_index, len(r.ring)) for r in rings.collect()) == [
        (1, 0, 5), (2, 0, 5), (3, 0, 2), (4, 0, 3), (5, 0, 5), (5, 1, 5), (77, 0, 5),
    ]


def test_ring_centroids(features):
    got = {(r.LocationID, r.ring_index): tuple(r)[2:] for r in geo.ring_centroid(geo.exterior_rings(features)).collect()}
    assert got[1, 0] == (4.0, 1.0, 1.0)
    assert got[2, 0] == (-4.0, 1.0, 1.0)
    assert got[3, 0] == got[4, 0] == (0.0, 0.0, 0.0)
    assert got[5, 1] == pytest.approx((1.0, 10.5, 0.5))


def test_zone_centroids(spark, features):
    got = {r.LocationID: r for r in geo.zone_centroids(features, zones(spark)).collect()}
    assert (got[1].zone, got[1].borough, got[1].service_zone) == ("Newark", "EWR", "EWR")
    assert (got[77].zone, got[77].borough, got[77].service_zone) == ("z77", "b", "")
    assert (got[5].zone, got[5].service_zone) == ("z5", "")  # lookup row without names
    assert (got[3].centroid_lon, got[3].centroid_lat) == (2.0, 2.0)  # mean of the points
    assert got[5].centroid_lon == pytest.approx((1 * 4 + 10.5) / 5)
    assert (got[5].min_lon, got[5].max_lon, got[5].max_lat) == (0.0, 11.0, 2.0)


def test_feature_without_coordinates_fails(spark, tmp_path):
    (tmp_path / "bad.geojson").write_text(collection([(1, "Polygon", [])]))
    bad = SRC.scan_geojson(spark, str(tmp_path / "bad.geojson"))
    with pytest.raises(Exception, match="no polygon coordinates"):
        geo.zone_centroids(bad, zones(spark)).collect()


def test_areas_of_one_small_file_are_dealt_to_all_tasks(spark, tmp_path):
    """Documents and geometry cost much more than the bytes of their customers, which are one task of a scan."""
    from hourgrid.sources import fixture as FX

    rows = [(k, f"c{k}", "s") for k in range(200)] + [(None, "c", None), (7, "c7", "s")]
    spark.createDataFrame(rows, "c_custkey bigint, c_name string, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    areas = FX.customer_areas(spark, str(tmp_path))
    assert areas.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(repr, map(tuple, areas.collect()))) == sorted(map(repr, rows))
