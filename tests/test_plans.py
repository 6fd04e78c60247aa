from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from asterloom.operators.quality import QualityError
from asterloom.plans import arrivals, music, sessions
from asterloom.schemas import ARRIVALS_RAW, ARRIVALS_STAR, MUSIC_STAR
from asterloom.sources.files import read_table, render_path
from asterloom.sources.labels import read_scripts

from .conftest import rows
from .test_values import LABELS

T0 = 1541052920350  # 2018-11-01 06:15:20.350, a Thursday


def event(**over):
    base = {
        "artist": "ann", "auth": "Logged In", "firstName": "Lia", "gender": "F", "itemInSession": 0, "lastName": "Ortega",
        "length": 246.3, "level": "free", "location": "Rome", "method": "PUT", "page": "NextSong", "registration": 1.5e12,
        "sessionId": 377, "song": "one", "status": 200, "ts": T0, "userAgent": "ua", "userId": "41",
    }
    return {**base, **over}


PLAYS = [
    event(),
    event(),  # an exact repeat
    event(itemInSession=1, ts=T0 + 3, song="two", length=100.0),  # same second, same session
    event(itemInSession=2, ts=T0 + 5000, song=None, artist=None, length=None, level="paid"),
    event(itemInSession=0, ts=T0 - 86_400_000, sessionId=9, level="free", firstName="Liana"),
    event(page="Home", song=None, artist=None, length=None, ts=T0 + 9000),
    event(userId="", page="Login", sessionId=77),
    event(userId="11", sessionId=5, artist="bob", ts=T0 + 7, length=246.9),
]


def song(song_id, artist_id, name, title, duration, **over):
    base = {"num_songs": 1, "artist_latitude": None, "artist_longitude": None, "artist_location": "", "year": 0}
    return {**base, "song_id": song_id, "artist_id": artist_id, "artist_name": name, "title": title, "duration": duration, **over}


CATALOGUE = [
    song("S1", "A1", "ann", "one", 246.3),
    song("S2", "A1", "Ann X", "two", 100.0, artist_location="Oslo", artist_latitude=59.9, artist_longitude=10.7, year=1999),
    song("S3", "A2", "bob", "one", 246.3),
    song("S4", "A1", "ann", "one", 246.3),  # the same name and length again
]


@pytest.fixture
def raw(local, folder):
    for i, e in enumerate(PLAYS):
        path = local / f"log_data/2018/11/{i % 2}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        with path.open("a") as f:
            f.write(json.dumps(e) + "\n")
    for s in CATALOGUE:
        path = local / f"song_data/A/{s['song_id'][-1]}/{s['song_id']}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(s))
    return folder


@pytest.fixture
def staged(spark, raw):
    return music.stage_log(spark, f"{raw}/log_data"), music.stage_catalogue(spark, f"{raw}/song_data")


def test_mapped_staging_equals_staging_by_name(spark, raw, staged):
    mapped = music.stage_log(spark, f"{raw}/log_data", music.LOG_MAPPING)
    assert mapped.schema == staged[0].schema
    assert rows(mapped) == rows(staged[0]) and mapped.count() == 7


def test_users_keep_first_names_and_last_level(staged):
    log, _ = staged
    assert rows(music.users_dim(log)) == [(11, "Lia", "Ortega", "F", "free"), (41, "Liana", "Ortega", "F", "paid")]
    assert music.users_distinct(log).count() == 4


def test_songs_and_artists(staged):
    _, catalogue = staged
    assert music.songs_dim(catalogue).count() == 4
    # Song S1 names the artist; the last song, S4, leaves its place empty.
    assert rows(music.artists_dim(catalogue)) == [("A1", "ann", "", None, None), ("A2", "bob", "", None, None)]


def test_time_of_plays_or_of_all_events(staged):
    log, _ = staged
    assert music.time_dim(log).count() == 5
    assert music.time_dim(log, page=None).count() == 6
    first = music.time_dim(log, weekday_style="sun1").orderBy("start_time").first()
    assert first.start_time == dt.datetime(2018, 10, 31, 6, 15, 20, 350000) and first.weekday == 4


def test_fact_keeps_every_play_once(staged):
    log, catalogue = staged
    fact = music.songplays_fact(log, catalogue)
    assert fact.count() == 5 and fact.select("songplay_id").distinct().count() == 5
    found = rows(fact.filter("song_id is not null").select("user_id", "session_id", "song_id", "artist_id"))
    assert found == [(41, 377, "S1", "A1"), (41, 9, "S1", "A1")]
    assert music.songplays_fact(log, catalogue, how="inner").count() == 2
    # Artist and length differ for two of the plays.
    assert rows(music.songplays_fact(log, catalogue, how="inner").select("year", "month").distinct()) == [(2018, 10), (2018, 11)]


def test_whole_second_match(staged):
    log, catalogue = staged
    fact = music.songplays_fact(log, catalogue, match="song_whole_seconds")
    # Each play of "one" by ann meets S1 and S4; bob's 246.9 is not 246.
    assert fact.filter("song_id is not null").count() == 4
    assert fact.count() == 7 and fact.select("songplay_id").distinct().count() == 7


def test_title_and_artist_matches(staged):
    log, catalogue = staged
    by_title = music.songplays_fact(log, catalogue, match="title", how="inner")
    assert rows(by_title.groupBy("song_id").count()) == [("S1", 2), ("S3", 1), ("S4", 2)]
    by_artist = music.songplays_fact(log, catalogue, match="artist", how="inner")
    assert by_artist.count() == 3 * 2 + 1
    assert by_artist.select("songplay_id").distinct().count() == by_artist.count()
    with pytest.raises(ValueError):
        music.songplays_fact(log, catalogue, match="nothing")


def test_load_star(spark, raw):
    star = music.load_star(spark, f"{raw}/log_data", f"{raw}/song_data", f"{raw}/star")
    assert {s.name: star[s.name].count() for s in MUSIC_STAR} == {
        "users": 2, "songs": 4, "artists": 2, "time": 5, "songplays": 5,
    }
    orphans = {name: rows(df) for name, df in music.star_orphans(star).items()}
    assert orphans == {"users": [], "time": [], "songs": [(None,)], "artists": [(None,)]}
    again = music.load_star(
        spark, f"{raw}/log_data", f"{raw}/song_data", f"{raw}/star", match="title", how="inner", mapping=music.LOG_MAPPING
    )
    assert again["songplays"].count() == 5


def test_a_load_may_be_repeated(spark, raw):
    args = (spark, f"{raw}/log_data", f"{raw}/song_data", f"{raw}/star")
    once = {name: rows(df) for name, df in music.load_star(*args, append_fact=True).items()}
    again = music.load_star(*args, append_fact=True)
    assert {name: rows(df) for name, df in again.items()} == once


def test_a_later_run_adds_to_the_star(spark, local, raw):
    args = (f"{raw}/song_data", f"{raw}/star")
    music.load_star(spark, f"{raw}/log_data", *args)
    day = local / "log_data/2018/12/0.json"
    day.parent.mkdir(parents=True)
    day.write_text(json.dumps(event(ts=T0 + 30 * 86_400_000, firstName="L.", level="paid")) + "\n")
    path = render_path(f"{raw}/log_data/{{year}}/{{month}}", {"year": 2018, "month": 12})
    star = music.load_star(spark, path, *args, append_fact=True)
    assert star["songplays"].count() == 6 and star["time"].count() == 6
    assert (41, "Liana", "Ortega", "F", "paid") in rows(star["users"]) and star["users"].count() == 2


def test_plays_without_a_user_are_refused_or_kept(spark, local, raw):
    (local / "log_data/2018/11/9.json").write_text(json.dumps(event(userId="", ts=T0 + 77)) + "\n")
    args = (spark, f"{raw}/log_data", f"{raw}/song_data", f"{raw}/star")
    with pytest.raises(QualityError, match="plays holds NULLs: {'userId': 1}"):
        music.load_star(*args)
    assert not (local / "star").exists()
    star = music.load_star(*args, keep_unknown_users=True)
    assert star["songplays"].count() == 6 and star["songplays"].filter("user_id is null").count() == 1


def test_plays_with_one_key_are_one_play(spark, local, raw):
    """Another user at the same item and time: the least user's play stays, and the load may be repeated."""
    (local / "log_data/2018/11/9.json").write_text("".join(
        json.dumps(event(userId=u, sessionId=77, itemInSession=3, ts=T0 + 9)) + "\n" for u in ("30", "20", "25")))
    args = (spark, f"{raw}/log_data", f"{raw}/song_data", f"{raw}/star")
    for _ in range(2):
        star = music.load_star(*args, append_fact=True)
        assert star["songplays"].count() == 6
        assert rows(star["songplays"].filter("session_id = 77").select("user_id")) == [(20,)]


def test_a_refused_load_leaves_the_whole_star(spark, local, raw, monkeypatch):
    args = (spark, f"{raw}/log_data", f"{raw}/song_data", f"{raw}/star")
    music.load_star(*args)
    before = {p: p.read_bytes() for p in sorted((local / "star").rglob("*")) if p.is_file()}
    monkeypatch.setattr(music, "first_plays", lambda fact: fact.unionAll(fact))
    with pytest.raises(QualityError, match="songplays holds rows with the same"):
        music.load_star(*args)
    assert {p: p.read_bytes() for p in sorted((local / "star").rglob("*")) if p.is_file()} == before


def test_distinct_songs_and_artists(staged):
    _, catalogue = staged
    assert music.songs_distinct(catalogue.union(catalogue)).count() == 4
    assert music.artists_distinct(catalogue).count() == 3


def test_fact_on_whole_seconds(staged):
    log, catalogue = staged
    fact = music.songplays_fact(log, catalogue, whole_seconds=True)
    assert fact.count() == 5
    assert {t.microsecond for (t,) in rows(fact.select("start_time"))} == {0}
    # Two plays of session 377 are 3 ms apart and share a key.
    assert fact.select("songplay_id").distinct().count() == 4


def test_query_tables(spark, local, folder):
    header = "artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,registration,sessionId,song,status,ts,userId\n"

    def line(artist, item, session, title, user, name="Lia", length="301.25"):
        return f'"{artist}",In,{name},F,{item},Ortega,{length},free,"Rome, IT",PUT,NextSong,1.5E+12,{session},"{title}",200,1.54E+12,{user}\n'

    for day, body in (
        ("a/01.csv", line("Halcyon", 6, 512, "Tides, Turning", 63) + line("", 0, 1, "", 3)),
        ("b/02.csv", line("Two", 1, 377, "t1", 41) + line("One", 0, 377, "t0", 41) + line("Three", 0, 183, "t1", 11, "Bo")
         + line("Three", 0, 184, "t1", 11, "Bo")),
    ):
        path = local / "csv" / day
        path.parent.mkdir(parents=True)
        path.write_text(header + body)
    tables = sessions.load_query_tables(spark, f"{folder}/csv", f"{folder}/out", csv_path=f"{folder}/one")
    assert rows(sessions.heard_at(tables["session_items"], 512, 6)) == [("Halcyon", "Tides, Turning", 301.25)]
    heard = [tuple(r) for r in sessions.heard_by(tables["user_sessions"], 41, 377).collect()]
    assert heard == [("One", "t0", "Lia", "Ortega"), ("Two", "t1", "Lia", "Ortega")]
    assert rows(sessions.listeners_of(tables["song_users"], "t1")) == [("Bo", "Ortega"), ("Lia", "Ortega")]
    kept = spark.read.option("header", True).csv(f"{folder}/one")
    assert kept.columns == list(sessions.CONSOLIDATED) and kept.count() == 5


def arrival(cicid, **over):
    base = {
        "i94yr": 2016.0, "i94mon": 4.0, "i94port": "HBR", "i94addr": "GA", "arrdate": 20574.0, "depdate": None, "i94mode": 1.0,
        "i94visa": 2.0, "i94cit": 711.0, "i94res": 711.0, "biryear": 1985.0, "gender": "F", "insnum": None, "airline": "DL",
        "admnum": 70011223344.0, "fltno": "00299", "visatype": "B2",
    }
    return tuple({"cicid": float(cicid), **base, **over}[f.name] for f in ARRIVALS_RAW.fields)


@pytest.fixture
def arrivals_star(spark, local, folder):
    (local / "labels.sas").write_text(LABELS)
    people = [
        arrival(1), arrival(1), arrival(2, i94addr="07", depdate=20580.0, gender="M"), arrival(3, i94addr=None, i94cit=412.0),
        arrival(4, i94addr="YH", i94cit=999.0, i94port="XXX", biryear=None),
    ]
    spark.createDataFrame(people, ARRIVALS_RAW).write.parquet(f"{folder}/arrivals")
    (local / "cities.csv").write_text(
        "City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;"
        "Average Household Size;State Code;Race;Count\n"
        "Harbour;Georgia;33.8;10;11;21;1;2;2.2;GA;White;5\nHarbour;Georgia;33.8;10;11;21;1;2;2.2;GA;Asian;6\n"
        "Zug;X;40;1;1;2;0;0;1.1;07;White;2\n"
    )
    (local / "airports.csv").write_text(
        "ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates\n"
        'K1,large,Harbour Field,1,NA,US,US-GA,Harbour,K1,HBR,HBR,"-84.4, 33.6"\n'
        'K2,small,No Code,1,NA,US,US-GA,Rome,K2,,,"-85.1, 34.3"\n'
        'K3,small,Bad Place,1,NA,US,GA,Rome,K3,BAD,,somewhere\n'
        'L1,large,Lagos,1,AF,NG,NG-LA,Lagos,L1,LOS,,"3.3, 6.5"\n'
    )
    (local / "temps.csv").write_text(
        "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
        "3770-01-01,2.1,3.2,Abilene,United States,1N,2W\n3770-01-01,2.1,3.2,Abilene,United States,1N,2W\n"
        "1743-11-01,,,Akron,United States,1N,2W\n1743-11-01,6.0,1.7,Oslo,Norway,1N,2W\n"
    )
    return arrivals.load_star(
        spark, f"{folder}/labels.sas", f"{folder}/arrivals", f"{folder}/cities.csv", f"{folder}/airports.csv",
        f"{folder}/temps.csv", f"{folder}/star",
    )


def test_arrivals_star(spark, arrivals_star, local, folder):
    star = arrivals_star
    assert {s.name: star[s.name].count() for s in ARRIVALS_STAR} == {
        "country_code": 3, "port_code": 5, "state_code": 3, "visa_code": 3, "travel_code": 2,
        "dim_immi_personal": 4, "dim_immi_airline": 4, "dim_demographic_population": 3, "dim_demographic_statistics": 2,
        "dim_airport": 2, "dim_temperature": 3, "fact_immi": 4,
    }
    fact = star["fact_immi"]
    assert rows(fact.select("cic_id", "arrive_date", "departure_date", "state_code", "country")) == [
        (1, dt.date(2016, 4, 30), None, "GA", "United States"),
        (2, dt.date(2016, 4, 30), dt.date(2016, 5, 6), "07", "United States"),
        (3, dt.date(2016, 4, 30), None, None, "United States"), (4, dt.date(2016, 4, 30), None, "YH", "United States"),
    ]
    assert fact.select("immigration_id").distinct().count() == 4
    assert (local / "star/fact_immi/state_code=07").is_dir()
    assert star["dim_immi_airline"].filter("cic_id = 1").first().admin_num == 70011223344
    assert rows(star["dim_airport"].select("iata_code", "state_code", F.round("longitude", 1).cast("string"))) == [
        ("BAD", None, None), ("HBR", "GA", "-84.4"),
    ]
    assert rows(star["dim_temperature"].select("record_id", "year", "month", "city")) == [
        (0, 1743, 11, "Akron"), (1, 3770, 1, "Abilene"), (2, 3770, 1, "Abilene"),
    ]
    assert rows(star["dim_demographic_statistics"].select("city", "median_age")) == [("HARBOUR", "33.8"), ("ZUG", "40")]
    assert rows(star["dim_demographic_population"].select("city").distinct()) == [("Harbour",), ("Zug",)]


def test_arrivals_analyses(spark, arrivals_star):
    star = arrivals_star
    personal, countries = star["dim_immi_personal"], star["country_code"]
    northmark = "NORTHMARK by Ferry, and Not Named (N-1, no other ways)"
    assert [tuple(r) for r in arrivals.top_citizen_countries(personal, countries).collect()] == [
        (northmark, 2), ("EASTMARK", 1), (None, 0),
    ]
    assert [tuple(r) for r in arrivals.top_states(star["fact_immi"], star["state_code"]).collect()] == [(None, 0)]
    assert [tuple(r) for r in arrivals.top_birth_years(personal).collect()] == [(1985, 3), (None, 0)]
    assert [tuple(r) for r in arrivals.gender_by_country(personal, countries, [northmark, "JAPAN"]).collect()] == [
        (northmark, "F", 1), (northmark, "M", 1),
    ]
    assert dict(rows(arrivals.integrity(star))) == {
        "airline": 0, "airports": 1, "population": 2, "statistics": 2, "personal": 0,
    }


def test_keys_are_the_same_on_the_next_run(spark, arrivals_star, folder):
    again = arrivals.fact_immi(spark.read.schema(ARRIVALS_RAW).parquet(f"{folder}/arrivals").repartition(5))
    assert rows(again.select("immigration_id")) == rows(read_table(spark, ARRIVALS_STAR[-1], f"{folder}/star").select("immigration_id"))


def test_city_codes(spark, local, folder):
    (local / "labels.sas").write_text(LABELS)
    ports = arrivals.port_codes_by_city(read_scripts(spark, f"{folder}/labels.sas"))
    cities = spark.createDataFrame([("HARBOUR",), ("ZUG",)], "city string")
    assert rows(arrivals.with_city_code(cities, ports)) == [("HARBOUR", "HB2"), ("ZUG", "ZUG")]
