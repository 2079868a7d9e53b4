"""Fixed values of the air-quality pipelines. They must stay as they are for results to agree."""

# fixed values: id, name, slug, latitude, longitude
CITIES = [
    (1, "Paris", "paris", 48.8566, 2.3522),
    (2, "Lyon", "lyon", 45.7640, 4.8357),
    (3, "Marseille", "marseille", 43.2965, 5.3698),
    (4, "Toulouse", "toulouse", 43.6047, 1.4442),
    (5, "Bordeaux", "bordeaux", 44.8378, -0.5792),
    (6, "Lille", "lille", 50.6292, 3.0573),
    (7, "Strasbourg", "strasbourg", 48.5734, 7.7521),
    (8, "Nice", "nice", 43.7102, 7.2620),
    (9, "Nantes", "nantes", 47.2184, -1.5536),
    (10, "Grenoble", "grenoble", 45.1885, 5.7245),
    (11, "Rennes", "rennes", 48.1173, -1.6778),
    (12, "Reims", "reims", 49.2583, 4.0317),
    (13, "Le Havre", "le-havre", 49.4944, 0.1079),
    (14, "Saint-Etienne", "saint-etienne", 45.4347, 4.3900),
    (15, "Toulon", "toulon", 43.1242, 5.9280),
    (16, "Angers", "angers", 47.4784, -0.5632),
    (17, "Dijon", "dijon", 47.3220, 5.0415),
    (18, "Brest", "brest", 48.3905, -4.4860),
    (19, "Nimes", "nimes", 43.8367, 4.3601),
    (20, "Aix-en-Provence", "aix-en-provence", 43.5297, 5.4474),
    (21, "Clermont-Ferrand", "clermont-ferrand", 45.7772, 3.0870),
    (22, "Tours", "tours", 47.3941, 0.6848),
    (23, "Amiens", "amiens", 49.8942, 2.2957),
    (24, "Metz", "metz", 49.1193, 6.1757),
    (25, "Montpellier", "montpellier", 43.6108, 3.8767),
    (26, "Rouen", "rouen", 49.4432, 1.0999),
    (27, "Caen", "caen", 49.1829, -0.3707),
    (28, "Nancy", "nancy", 48.6921, 6.1844),
    (29, "Perpignan", "perpignan", 42.6887, 2.8948),
    (30, "Orleans", "orleans", 47.9029, 1.9039),
]
CITY_SCHEMA = "id int, nom string, slug string, latitude double, longitude double"

# fixed values: id, name, unit, source
POLLUTANTS = [
    ("aqi", "AQI Global", "Index", "AQICN"),
    ("pm25", "PM2.5", "µg/m³", "AQICN"),
    ("pm10", "PM10", "µg/m³", "AQICN"),
    ("no2", "NO2", "µg/m³", "AQICN"),
    ("o3", "Ozone", "µg/m³", "AQICN"),
    ("co", "CO", "µg/m³", "AQICN"),
    ("so2", "SO2", "µg/m³", "AQICN"),
    ("aqi_owm", "AQI OWM", "1-5", "OWM"),
    ("pm2_5", "PM2.5 OWM", "µg/m³", "OWM"),
    ("no2_owm", "NO2 OWM", "µg/m³", "OWM"),
    ("o3_owm", "Ozone OWM", "µg/m³", "OWM"),
    ("nh3", "NH3", "µg/m³", "OWM"),
]
POLLUTANT_SCHEMA = "polluant_id string, polluant_nom string, unite string, source string"

# fixed values: inclusive valid range by kind of quantity
RANGES = {
    "co": (0, 50000),
    "no2": (0, 2000),
    "o3": (0, 500),
    "so2": (0, 1000),
    "pm25": (0, 500),
    "pm10": (0, 600),
    "t": (-60, 60),
    "h": (0, 100),
    "p": (870, 1084),
    "w": (0, 200),
}

# fixed values: five-level index code to the common scale
INDEX_SCALE = {1: 25, 2: 75, 3: 100, 4: 150, 5: 200}

# fixed values: order in which tied pollutants win, feed field, factor used for the comparison only
DOMINANCE = {
    "pm25": ("pm2_5", 1.0),
    "pm10": ("pm10", 1.0),
    "no2": ("no2", 1.0),
    "o3": ("o3", 1.0),
    "so2": ("so2", 1.0),
    "co": ("co", 0.01),
}

# fixed values: output columns of the hourly history
HISTORY_COLUMNS = [
    "id", "ville_id", "collecte_le", "mesure_le", "station_timezone", "aqi_global",
    "pm25", "pm10", "no2", "o3", "co", "so2", "temperature", "humidite", "pression", "vent",
    "polluant_dominant", "station_nom", "station_url", "station_idx", "attributions",
]

# fixed values: features of the analytics jobs, most severe index first
AIR_FEATURES = ["aqi_global", "pm25", "pm10", "no2", "o3"]
