"""Hand-written landed payloads with every shape FIXTURES.md asks for."""

import json
import os

MS = 1709287200000  # 2024-03-01T10:00:00Z


def feature(mag, place, t, lon_lat, updated=True, title="M title"):
    props = {"mag": mag, "time": t, "tz": None, "url": "u", "detail": "d", "felt": None, "cdi": None, "mmi": None,
             "alert": None, "status": "reviewed", "tsunami": 0, "sig": 10, "net": "us", "code": "c", "ids": ",x,",
             "sources": ",us,", "types": ",origin,", "nst": 5, "dmin": 0.1, "rms": 0.2, "gap": 30, "magType": "ml",
             "type": "earthquake", "title": title}
    if place is not None:
        props["place"] = place
    if updated:
        props["updated"] = t + 60000
    return {"type": "Feature", "properties": props, "geometry": {"type": "Point", "coordinates": lon_lat}}


EVENT_FEEDS = [
    {"type": "FeatureCollection", "features": [
        feature(2.5, "10 km N of Town, CA", MS, [-120.51, 35.21, 5.0]),           # good, commas in place
        feature(3.1, "Quiet Valley", MS + 1000, [-118.02, 34.05, 1.0]),            # good
        feature(2.2, "Lone", MS + 2000, [-117.0]),                                # one coordinate
        feature(2.3, "x", MS + 3000, [-116.0, 33.0]),                              # 1-char place -> null key
        feature(2.4, None, MS + 4000, [-116.0, 33.0]),                             # place missing -> null key
        feature(2.6, "Far Hill", MS + 5000, [-119.5, 36.5], updated=False),        # updated missing
        feature(1.5, "Too Small", MS + 6000, [-119.5, 36.5]),                      # below magnitude 2
        feature(4.0, "Yesterday", MS - 86_400_000, [-119.5, 36.5]),                 # outside the feed window
    ]},
    {"type": "FeatureCollection", "features": []},
]

WEATHER = [
    {"lat": 35.2123, "lon": -120.5081, "tz": "-08:00", "date": "2024-03-01", "units": "standard",
     "cloud_cover": {"afternoon": 40.0}, "humidity": {"afternoon": 60.0}, "precipitation": {"total": 1.5},
     "temperature": {"min": 280.15, "max": 290.15}, "pressure": {"afternoon": 1015.0}, "wind": {"max": {"speed": 7.5, "direction": 120}}},
    {"lat": 34.05, "lon": -118.02, "tz": "-08:00", "date": "2024-03-01", "units": "standard",
     "cloud_cover": {"afternoon": 10.0}, "humidity": {"afternoon": 30.0}, "precipitation": {"total": 0.0},
     "temperature": {"min": 285.0, "max": 295.0}, "pressure": {"afternoon": 1012.0}},                       # wind absent
    {"lat": 36.5, "lon": -119.5, "tz": "-08:00", "date": "2024-03-01", "units": "standard",
     "temperature": {"min": 281.0, "max": 291.0}, "wind": {"max": 3.0}},                                      # wind.max scalar
    {"lat": 33.0, "lon": -116.0, "tz": "-08:00", "date": "2024-03-01", "units": "standard"},                # temperature absent
    {"lat": 33.5, "lon": -116.5, "tz": "-08:00", "date": "2024-03-01", "units": "standard",
     "temperature": {"min": -5.0, "max": 290.0}},                                                            # negative Kelvin
    {"lat": 33.7, "lon": -116.7, "tz": "-08:00", "date": "2024-03-01", "units": "standard",
     "temperature": {"min": 280.0, "max": None}},                                                            # null maximum
]

CENSUS = [
    ["NAME", "POP", "HISP", "state", "county"],
    ["San Luis Obispo County, California", "282424", "0", "06", "079"],
    ["Acadia Parish, Louisiana", "62045", "0", "22", "001"],
    ["District Without Comma", "1000", "0", "11", "001"],
    ["Odd County, Place, Extra", "5", "0", "99", "999"],
    ["Orange County, California", "3175692", "0", "06", "059"],
    ["Orange County, Florida", "1393452", "0", "12", "095"],
]


def geo(name, lat, lon, country="US", state="California"):
    return {"name": name, "local_names": {"en": name}, "lat": lat, "lon": lon, "country": country, "state": state}


GEOCODE = [
    [geo("San Luis Obispo", 35.2828, -120.6596), geo("San Luis Obispo", 35.2828, -120.6596),  # exact duplicate
     geo("San Luis Obispo", 35.21, -120.51), geo("Obispo Town", 35.21, -120.51),              # two names at one point
     geo("San Luis", 14.0, -90.0, country="GT", state=None),                                   # non-US
     geo("San Luis Sixth", 35.0, -120.0)],                                                      # 6th result, beyond limit
    [geo("Orange", 34.05, -118.02), geo("Orange", 28.54, -81.38, state="Florida")],
    [geo("Quiet Valley", 36.5, -119.5)],
]


def write_lines(root, sub, items):
    os.makedirs(os.path.join(root, sub), exist_ok=True)
    with open(os.path.join(root, sub, "part-0.json"), "w") as fh:
        for it in items:
            fh.write(json.dumps(it) + "\n")


def write(root, skip=()):
    """Write the payloads as JSON Lines folders under ``root`` (except those in ``skip``); returns root."""
    for sub, items in (("events", EVENT_FEEDS), ("weather", WEATHER), ("census", [CENSUS]), ("geocode", GEOCODE)):
        if sub not in skip:
            write_lines(root, sub, items)
    return root
