"""A small hostile motor-racing fixture (FIXTURES.md §6): the wide CSV and
topic messages.  Test-only input; no registered query uses it."""

from __future__ import annotations

import json

from tarmac.schemas import CSV_COLUMNS

N = "\\N"

BASE = {
    "statusId": "1", "status": "Finished",
    "constructorStandingsId": "10", "points_constructorstandings": "25", "position_constructorstandings": "1",
    "positionText_constructorstandings": "1", "wins_constructorstandings": "1",
    "driverStandingsId": "20", "points_driverstandings": "25", "position_driverstandings": "1",
    "positionText_driverstandings": "1",
    "driverId": "0", "driverRef": "max", "number_drivers": "33", "code": "VER", "forename": "Max",
    "surname": "V", "dob": "1997-09-30", "nationality": "Dutch", "url": "u/max",
    "constructorId": "0", "constructorRef": "rb", "name": "Red Bull", "nationality_constructors": "Austrian",
    "url_constructors": "u/rb",
    "stop": "1", "raceId": "0", "lap_pitstops": "12", "time_pitstops": "14:01:02", "duration": "23.004",
    "milliseconds_pitstops": "23004",
    "lap": "1", "position_laptimes": "1", "time_laptimes": "1:10.040", "milliseconds_laptimes": "70040",
    "quali_date": N, "quali_time": N, "fp1_date": N, "fp1_time": N, "fp2_date": "2024-03-01",
    "fp2_time": "11:00:00", "fp3_date": N, "fp3_time": N, "sprint_date": N, "sprint_time": N,
    "circuitId": "0", "circuitRef": "monza", "name_y": "Monza", "location": "Monza", "country": "Italy",
    "lat": "45.6156", "lng": "9.28111", "alt": N, "url_y": "u/monza",
    "year": "2024", "round": "1", "laps": "53", "fastestLap": "40", "fastestLapTime": "1:21.046",
    "fastestLapSpeed": "257.1", "name_x": "GP One", "date": "2024-03-02", "time_races": "15:00:00",
    "url_x": "u/r1",
    "resultId": "0", "grid": "1", "position": "1", "rank": "1", "time": "1:31:44.742",
    "milliseconds": "5504742", "points": "25", "number": "33", "positionOrder": "1", "positionText": "1",
    "wins": "1",
}


def csv_rows() -> list[tuple]:
    rows = [
        {},                                                                   # plain row
        {},                                                                   # full-row duplicate
        {"lap": "2", "time_laptimes": "1:09.500", "milliseconds_laptimes": "69500"},
        {"lap": "1", "time_laptimes": "1:99.999", "milliseconds_laptimes": "1"},   # dup lap key: later loses
        {"laps": "54"},                                                       # dup raceId: first CSV row wins (Q18)
        {"resultId": "1", "driverId": "1", "driverRef": "lewis", "number_drivers": N, "code": N,
         "forename": "Lewis", "surname": "H", "url": "u/lewis", "constructorId": "1", "constructorRef": "merc",
         "name": "Mercedes", "position": "R", "positionText": "R", "points": "12.5", "stop": "2",
         "duration": "1:14.773", "statusId": "2", "status": "+1 Lap", "driverStandingsId": "21",
         "positionText_driverstandings": "D"},
        {"resultId": "1", "driverId": "1", "driverRef": "lewis", "url": "u/lewis-2",     # variant of a driver (Q16)
         "forename": "Lewis", "surname": "H", "number_drivers": "44"},
        {"raceId": "1", "round": "2", "name_x": "GP Two", "url_x": "u/r2", "resultId": "2",
         "quali_date": "2024-03-08", "quali_time": "14:00:00", "sprint_date": "2024-03-09",
         "sprint_time": "12:00:00", "time_races": N, "lat": "not a number"},
    ]
    return [tuple({**BASE, **r}.get(c) for c in CSV_COLUMNS) for r in rows]


def msg(topic: str, key: str, value: dict, partition: int, offset: int) -> tuple:
    return (key, json.dumps(value), topic, partition, offset)


def stream_messages() -> list[tuple]:
    """One micro-batch of all nine topics, season 2024."""
    m = []
    o = iter(range(1000))
    m.append(msg("status_topic", "3", {"statusId": "3", "status": "Collision"}, 0, next(o)))
    m.append(msg("status_topic", "x", {"statusId": "x", "status": "Bad"}, 0, next(o)))          # P9 reject
    m.append(msg("status_topic", "1", {"statusId": "1", "status": "Finished"}, 0, next(o)))     # exists
    m.append(msg("driver_topic", "norris", {"driverId": "norris", "permanentNumber": "",
                                            "givenName": "Lando", "dateOfBirth": "1999-11-13"}, 0, next(o)))
    m.append(msg("driver_topic", "max", {"driverId": "max", "givenName": "Max"}, 0, next(o)))      # exists
    m.append(msg("constructor_topic", "mcl", {"constructorId": "mcl", "name": "McLaren"}, 0, next(o)))
    race = {"season": "2024", "round": "3", "raceName": "GP Three", "url": "u/r3", "date": "2024-04-01",
            "time": "05:00:00Z", "Circuit": {"circuitId": "suzuka", "circuitName": "Suzuka", "url": "u/s",
                                             "Location": {"lat": "-34.84", "long": "136.5", "locality": "S",
                                                          "country": "Japan"}},
            "SecondPractice": {"date": "2024-03-30", "time": "06:00:00Z"}}
    m.append(msg("race_topic", "2024_3", race, 1, next(o)))
    race4 = dict(race, round="4", raceName="GP Four", url="u/r4", SecondPractice=None,
                 Sprint={"date": "2024-04-07", "time": "03:00:00Z"})
    m.append(msg("race_topic", "2024_4", race4, 1, next(o)))           # two new races, one new circuit
    m.append(msg("race_topic", "2024_1", dict(race, round="1"), 1, next(o)))   # exists
    for lap, t, drv in [(3, "1:10.040", "max"), (3, "1:10.040", "max"), (4, "1:08.100", "max"),
                        (4, "1:08.100", "lewis"), (5, "1:09.000", "ghost")]:
        m.append(msg("laptimes_topic", f"{drv}_1_{lap}", {"round": 1, "lap": lap, "driverId": drv,
                                                           "position": 1, "time": t}, 2, next(o)))
    m.append(msg("pitstops_topic", "2_1_max", {"season": "2024", "round": "1", "stop": "2", "lap": "30",
                                               "driverId": "max", "time": "15:00:00", "duration": "1:02.500"},
                 2, next(o)))
    m.append(msg("pitstops_topic", "1_1_max", {"season": "2024", "round": "1", "stop": "1", "lap": "12",
                                               "driverId": "max", "time": "14:01:02", "duration": "23.004"},
                 2, next(o)))                                                           # exists
    res = {"season": "2024", "round": "2", "number": "33", "position": "1", "positionText": "1",
           "points": "25", "driverId": "max", "constructorId": "rb", "grid": "2", "laps": "53",
           "status": "Finished", "time": "1:30:00.000", "milliseconds": "5400000",
           "FastestLap": {"rank": "1", "lap": "44", "Time": {"time": "1:20.000"},
                          "AverageSpeed": {"units": "kph", "speed": "250.5"}}}
    m.append(msg("results_topic", "max_2", res, 3, next(o)))
    m.append(msg("results_topic", "lewis_2", dict(res, driverId="lewis", constructorId="merc", position="R",
                                                 positionText="R", points="12.5", FastestLap=None), 3, next(o)))
    m.append(msg("results_topic", "ghost_2", dict(res, driverId="ghost"), 3, next(o)))          # reject
    m.append(msg("results_topic", "max_1", dict(res, round="1"), 3, next(o)))                   # exists (Q2)
    doc = {"StandingsTable": {"season": "2024", "StandingsLists": [{"season": "2024", "round": "1",
           "ConstructorStandings": [{"position": "1", "positionText": "1", "points": "43", "wins": "1",
                                     "Constructor": {"constructorId": "rb"}},
                                    {"position": "2", "positionText": "2", "points": "12.5", "wins": "0",
                                     "Constructor": {"constructorId": "merc"}}]}]}}
    m.append(msg("constandings_topic", "doc", doc, 4, next(o)))
    m.append(msg("driverstandings_topic", "max_2024_1",
                 {"season": "2024", "round": "1", "position": "1", "positionText": "1", "points": "25",
                  "wins": "1", "Driver": {"driverId": "max"}, "Constructors": [{"constructorId": "rb"}]},
                 4, next(o)))
    return m
