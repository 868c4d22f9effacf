import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.windows import WindowSpec, pollution_results
from pulsegrid.plans.jobs import run_windows
from pulsegrid.schemas import EMISSION_EVENT, TRAFFIC_RESULT, pollution_result_schema
from pulsegrid.session import shared_dir
from pulsegrid.sources import emissions as em
from pulsegrid.sources import topics
from pulsegrid.streaming.landing import ONCE, read_revisions

XML = """<?xml version="1.0" encoding="UTF-8"?>
<emission-export>
    <timestep time="0.00">
        <vehicle id="truck0" type="truck_truck" eclass="HDV" x="3701.62" y="9001.43" speed="2.5" angle="90" CO2="10.5"
                 CO="1" HC="0.5" NOx="0.25" PMx="0.125" fuel="4" noise="60.5"/>
        <vehicle id="car1" x="0" y="0"/>
    </timestep>
    <timestep time="1.00"/>
    <timestep time="2.50">
        <vehicle id="car1" type="veh_passenger" x="0" y="0" CO2="3"/>
    </timestep>
</emission-export>
"""


@pytest.fixture
def document(tmp_path):
    folder = tmp_path / "xml"
    folder.mkdir()
    (folder / "a.xml").write_text(XML)
    return str(folder)


def test_xml(spark, document):
    rows = em.read_emission_xml(spark, document)
    assert set(rows.columns) == {f.name for f in EMISSION_EVENT.fields}
    found = sorted(rows.collect(), key=lambda r: (r.event_time_ms, r.vehicle_id))
    assert [(r.event_time_ms, r.vehicle_id, r.vehicle_type) for r in found] == [
        (0, "car1", None), (0, "truck0", "truck_truck"), (2500, "car1", "veh_passenger")]
    truck, car = found[1], found[0]
    assert (truck.lat, truck.lon, truck.CO2, truck.noise, truck.eclass) == (40.42064, -3.708337, 10.5, 60.5, "HDV")
    assert (car.lat, car.lon, car.speed, car.CO2, car.noise) == (40.339276, -3.751066, 0.0, 0.0, 0.0)


def test_xml_rejects(spark, tmp_path):
    good = '<timestep time="1.0"><vehicle id="a" x="1" y="2"/></timestep>'
    (tmp_path / "bad.xml").write_text(f"<emission-export>{good}<timestep time=\"2.0\"><vehicle id=oops></timestep>{good}</emission-export>")
    assert em.read_emission_xml(spark, str(tmp_path / "bad.xml")).count() == 2
    assert ["oops" in r.value for r in em.rejected_timesteps(spark, str(tmp_path / "bad.xml")).collect()] == [True]


VEHICLE = '<vehicle id="a" x="1" y="2"/>'
FAULTS = {
    "no closing tag": f'<timestep time="9.0">{VEHICLE}',
    "misspelt vehicle": '<timestep time="9.0"><vehicl id="c" x="1"/></timestep>',
    "one of two vehicles misspelt": f'<timestep time="9.0">{VEHICLE}<vehicel id="c"/></timestep>',
    "misspelt opening": f'<timstep time="9.0">{VEHICLE}</timestep>',
    "no attribute": f'<timestep {VEHICLE}</timestep>',
    "tag runs on": f'<timesteps time="9.0">{VEHICLE}</timestep>',
    "open quote": '<timestep time="9.0"><vehicle id="a x="1"/></timestep>',
    "vehicles behind the end": f'<timestep time="9.0"/>{VEHICLE}',
}


@pytest.mark.parametrize("fault", FAULTS)
@pytest.mark.parametrize("place", [0, 1, 3])
def test_every_faulty_timestep_is_rejected_and_its_neighbours_are_read(spark, tmp_path, fault, place):
    good = [f'<timestep time="{i}.0">{VEHICLE}<!-- <vehicle/> --></timestep>' for i in range(3)]
    good.insert(place, FAULTS[fault])
    (tmp_path / "d.xml").write_text('\n<?xml version="1.0"?>\n<!-- head -->\n<emission-export>\n' + "\n".join(good) + "\n</emission-export>\n")
    read = em.read_emission_xml(spark, str(tmp_path / "d.xml")).collect()
    assert sorted(r.event_time_ms for r in read) == [0, 1000, 2000]
    texts = [r.value for r in em.rejected_timesteps(spark, str(tmp_path / "d.xml")).collect()]
    assert len(texts) == 1
    if fault != "vehicles behind the end":
        assert FAULTS[fault].removeprefix("<timestep").strip() in texts[0]


def test_empty_timesteps_are_accepted(spark, tmp_path):
    (tmp_path / "d.xml").write_text('<emission-export><timestep time="1.0"/><timestep time="2.0"></timestep><timestep time="3.0"> </timestep></emission-export>')
    pieces = spark.read.option("lineSep", "<timestep").text(str(tmp_path / "d.xml"))
    decoded = em.timesteps_from_text(pieces)
    assert sorted(r._time for r in em.accepted(decoded).collect()) == [1.0, 2.0, 3.0] and em.rejected(decoded).count() == 0


def test_xml_stream(spark, document):
    path = shared_dir(spark, "xml-stream")
    stream = em.read_emission_xml(spark, document, stream=True, max_files_per_trigger=1)
    spec = WindowSpec("10 minutes")
    run_windows(stream, "pollution", spec, f"{path}/t", f"{path}/c", trigger=ONCE, pollutants="CO2").awaitTermination()
    schema = pollution_results(em.read_emission_xml(spark, document), spec, "CO2").schema
    assert read_revisions(spark, f"{path}/t", schema).agg(F.sum("vehicle_count")).first()[0] == 3


def test_json_messages(spark):
    messages = spark.createDataFrame([
        ('{"vehicle_id": "v", "lat": 40.4, "lon": -3.7, "CO2": 5.0, "event_time_ms": 1000, "x": 3}',),
        ('{"vehicle_id": "w", "lat":',), ('{"vehicle_id": "u", "CO2": "many"}',), ("",), (None,),
    ], "value string")
    decoded = em.decode_json(messages)
    assert [(r.vehicle_id, r.CO2, r.noise) for r in em.accepted(decoded).filter("vehicle_id is not null").collect()] == [
        ("v", 5.0, None)]
    assert sorted(r.value for r in em.rejected(decoded).collect()) == [
        '{"vehicle_id": "u", "CO2": "many"}', '{"vehicle_id": "w", "lat":']
    windows = pollution_results(em.accepted(decoded), WindowSpec("1 day"), "CO2")
    assert windows.count() == 1


def test_messages_leave_nulls_out_and_carry_a_key(spark):
    df = spark.createDataFrame([(40.4, -3.7, None)], "lat double, lon double, CO2_avg double")
    row = em.to_messages(df, key=["lat", "lon"]).first()
    assert (row.key, row.value) == ("40.4,-3.7", '{"lat":40.4,"lon":-3.7}')


def test_results_without_cell_are_skipped(spark):
    messages = spark.createDataFrame(
        [('{"lat": 1.0, "lon": 2.0, "CO2_avg": 1.5}',), ('{"lon": 2.0, "CO2_avg": 9}',)], "value string")
    assert [r.CO2_avg for r in em.read_results(messages, pollution_result_schema(["CO2"])).collect()] == [1.5]
    assert em.read_results(messages, TRAFFIC_RESULT).count() == 1


def test_message_files(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([(1,), (2,)], "a int")
    topics.write_message_files(em.to_messages(df), path)
    topics.write_message_files(em.to_messages(df), path)
    assert sorted(r.value for r in topics.read_message_files(spark, path, stream=False).collect()) == [
        '{"a":1}', '{"a":1}', '{"a":2}', '{"a":2}']


def test_topic_options():
    assert topics.source_options(["b1:9092", "b2:9092"], "events", group_id="g") == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "events", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "kafka.group.id": "g"}
    latest = topics.source_options("b:1", "results", starting_offsets="latest", max_offsets_per_trigger=5)
    assert latest["startingOffsets"] == "latest" and latest["maxOffsetsPerTrigger"] == "5"
    assert topics.sink_options("b:1", "results") == {
        "kafka.bootstrap.servers": "b:1", "topic": "results", "kafka.acks": "all", "kafka.retries": "5"}


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    steps = 2000
    body = "".join(
        f'  <timestep time="{i}.00">\n    <vehicle id="v{i}" x="1" y="2" CO2="{i}.5"/>\n    <vehicle id="w" x="1" y="2"/>\n  </timestep>\n'
        if i % 10 else f'  <timestep time="{i}.00"/>\n' for i in range(steps))
    (tmp_path / "big.xml").write_text(f'<?xml version="1.0"?>\n<emission-export>\n{body}</emission-export>\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20kb")
    try:
        rows = em.read_emission_xml(spark, str(tmp_path / "big.xml"))
        assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 5
        found = rows.agg(F.count("*").alias("n"), F.count_distinct("timestep").alias("t"), F.sum("CO2").alias("c")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    used = [i for i in range(steps) if i % 10]
    assert (found.n, found.t, found.c) == (2 * len(used), len(used), sum(i + 0.5 for i in used))
