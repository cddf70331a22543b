"""The airport dimension: small, fixed, and broadcast by its size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ICAO code, name, city, country.
AIRPORTS = [
    ("LEMD", "Adolfo Suárez Madrid-Barajas", "Madrid", "España"),
    ("LEBL", "Barcelona-El Prat", "Barcelona", "España"),
    ("LEAL", "Alicante-Elche", "Alicante", "España"),
    ("LEMG", "Málaga-Costa del Sol", "Málaga", "España"),
    ("LEVC", "Valencia-Manises", "Valencia", "España"),
    ("LEIB", "Ibiza", "Ibiza", "España"),
    ("LEPA", "Palma de Mallorca", "Palma", "España"),
    ("LEZG", "Zaragoza", "Zaragoza", "España"),
    ("LEAS", "Asturias", "Asturias", "España"),
    ("LEVX", "Vigo-Peinador", "Vigo", "España"),
    ("LESO", "San Sebastián", "San Sebastián", "España"),
    ("LEBB", "Bilbao", "Bilbao", "España"),
    ("LEXJ", "Santander-Seve Ballesteros", "Santander", "España"),
    ("LECO", "A Coruña", "A Coruña", "España"),
    ("LEGE", "Girona-Costa Brava", "Girona", "España"),
    ("LELL", "Sabadell", "Sabadell", "España"),
    ("LELN", "León", "León", "España"),
    ("LEGR", "Granada-José María Cordero", "Granada", "España"),
    ("LEJR", "Jerez", "Jerez", "España"),
    ("LEZL", "Sevilla-San Pablo", "Sevilla", "España"),
    ("LEBT", "Córdoba", "Córdoba", "España"),
    ("LEAB", "Albacete", "Albacete", "España"),
    ("LEMO", "Morón", "Morón", "España"),
    ("GCFV", "Fuerteventura", "Fuerteventura", "España"),
    ("GCLP", "Gran Canaria", "Gran Canaria", "España"),
    ("GCXO", "Tenerife Norte-Ciudad de La Laguna", "Tenerife", "España"),
    ("GCTS", "Tenerife Sur", "Tenerife", "España"),
    ("GCLA", "La Palma", "La Palma", "España"),
    ("GCGM", "La Gomera", "La Gomera", "España"),
    ("GCHI", "El Hierro", "El Hierro", "España"),
    ("GCJA", "Jandía", "Jandía", "España"),
    ("LEMH", "Menorca", "Menorca", "España"),
    ("LPPD", "Ponta Delgada-João Paulo II", "Azores", "Portugal"),
    ("LPPT", "Lisboa-Humberto Delgado", "Lisboa", "Portugal"),
    ("LPPR", "Porto-Francisco Sá Carneiro", "Porto", "Portugal"),
    ("LPFR", "Faro-Gago Coutinho", "Faro", "Portugal"),
    ("EGLL", "London Heathrow", "Londres", "Reino Unido"),
    ("EGKK", "London Gatwick", "Londres", "Reino Unido"),
    ("LFPG", "Paris Charles de Gaulle", "París", "Francia"),
    ("LFPO", "Paris Orly", "París", "Francia"),
    ("EDDF", "Frankfurt am Main", "Fráncfort", "Alemania"),
    ("EDDM", "Munich", "Múnich", "Alemania"),
    ("EDDB", "Berlin Brandenburg", "Berlín", "Alemania"),
    ("EHAM", "Amsterdam Schiphol", "Ámsterdam", "Países Bajos"),
    ("LIRF", "Roma Fiumicino", "Roma", "Italia"),
    ("LIML", "Milán Linate", "Milán", "Italia"),
    ("LSZH", "Zürich", "Zúrich", "Suiza"),
    ("LSGG", "Genève", "Ginebra", "Suiza"),
    ("LOWW", "Vienna International", "Viena", "Austria"),
    ("EKCH", "Copenhague Kastrup", "Copenhague", "Dinamarca"),
    ("ESSA", "Stockholm Arlanda", "Estocolmo", "Suecia"),
    ("ENGM", "Oslo Gardermoen", "Oslo", "Noruega"),
    ("EFHK", "Helsinki-Vantaa", "Helsinki", "Finlandia"),
    ("EPWA", "Varsovia Chopin", "Varsovia", "Polonia"),
    ("LKPR", "Václav Havel Prague", "Praga", "República Checa"),
    ("LHBP", "Budapest Liszt Ferenc", "Budapest", "Hungría"),
    ("LBSF", "Sofía", "Sofía", "Bulgaria"),
    ("LRBB", "Henri Coandă Bucarest", "Bucarest", "Rumanía"),
    ("LGAV", "Atenas Eleftherios Venizelos", "Atenas", "Grecia"),
    ("LTFM", "Estambul", "Estambul", "Turquía"),
    ("UUDD", "Moscú Domodedovo", "Moscú", "Rusia"),
    ("ULLI", "San Petersburgo Pulkovo", "San Petersburgo", "Rusia"),
]

# ICAO code, latitude, longitude in degrees (WGS84).
COORDINATES = [
    ("LEMD", 40.4719, -3.5626),
    ("LEBL", 41.2971, 2.0785),
    ("LEAL", 38.2822, -0.5582),
    ("LEMG", 36.6749, -4.4991),
    ("LEVC", 39.4893, -0.4816),
    ("LEIB", 38.8729, 1.3731),
    ("LEPA", 39.5517, 2.7387),
    ("LEZG", 41.6662, -1.0415),
    ("LEAS", 43.5636, -6.0346),
    ("LEVX", 42.2318, -8.6268),
    ("LESO", 43.3563, -1.7906),
    ("LEBB", 43.3011, -2.9106),
    ("LEXJ", 43.4271, -3.82),
    ("LECO", 43.3021, -8.3772),
    ("LEGE", 41.901, 2.7605),
    ("LELL", 41.52, 2.1048),
    ("LELN", 42.5888, -5.6557),
    ("LEGR", 37.1887, -3.7772),
    ("LEJR", 36.7446, -6.0601),
    ("LEZL", 37.418, -5.8931),
    ("LEBT", 37.842, -4.8489),
    ("LEAB", 38.9485, -1.8632),
    ("LEMO", 37.1749, -5.6159),
    ("LEMH", 39.8626, 4.2186),
    ("GCFV", 28.4527, -13.8638),
    ("GCLP", 27.9319, -15.3866),
    ("GCXO", 28.4827, -16.3415),
    ("GCTS", 28.0445, -16.5725),
    ("GCLA", 28.626, -17.7556),
    ("GCGM", 28.0296, -17.2146),
    ("GCHI", 27.8148, -17.8871),
    ("GCJA", 28.0486, -14.2403),
    ("LPPD", 37.7412, -25.6976),
    ("LPPT", 38.7756, -9.1354),
    ("LPPR", 41.2481, -8.6814),
    ("LPFR", 37.0141, -7.9657),
    ("EGLL", 51.47, -0.4543),
    ("EGKK", 51.1481, -0.1903),
    ("EIDW", 53.4213, -6.2701),
    ("LFPG", 49.0097, 2.5479),
    ("LFPO", 48.7233, 2.3794),
    ("LFLL", 45.7256, 5.0811),
    ("LFMN", 43.665, 7.215),
    ("EDDF", 50.0333, 8.5706),
    ("EDDM", 48.3538, 11.7861),
    ("EDDB", 52.3667, 13.5033),
    ("EDDH", 53.6304, 9.9882),
    ("EDDK", 50.8659, 7.1427),
    ("EHAM", 52.3086, 4.7639),
    ("EBBR", 50.9014, 4.4844),
    ("LIRF", 41.8003, 12.2389),
    ("LIML", 45.4451, 9.2773),
    ("LIMC", 45.63, 8.7231),
    ("LSZH", 47.4581, 8.548),
    ("LSGG", 46.2381, 6.1094),
    ("LSZB", 46.9139, 7.4971),
    ("LOWW", 48.1103, 16.5697),
    ("EKCH", 55.618, 12.656),
    ("ESSA", 59.6519, 17.9186),
    ("ENGM", 60.202, 11.0839),
    ("EFHK", 60.3183, 24.9633),
    ("EPWA", 52.1657, 20.9671),
    ("LKPR", 50.1008, 14.26),
    ("LHBP", 47.4297, 19.2611),
    ("LROP", 44.5711, 26.085),
    ("LBSF", 42.695, 23.4064),
    ("LGAV", 37.9364, 23.9475),
    ("LTFM", 41.2608, 28.7422),
    ("LMML", 35.8575, 14.4775),
    ("UUDD", 55.41, 37.9061),
    ("ULLI", 59.8004, 30.2625),
]

#: The city's airport has coordinates under another code.
SAME_PLACE = {"LRBB": "LROP"}

# Least latitude, greatest latitude, least longitude, greatest longitude.
BOXES = {"spain": (36.0, 43.8, -9.3, 4.3), "western_europe": (35.0, 60.0, -10.0, 25.0)}


def airports(spark: SparkSession) -> DataFrame:
    """icao, name, city, country, latitude, longitude; airports that only have coordinates have no name."""
    at = {c: (a, b) for c, a, b in COORDINATES}
    rows = [(*a, *at.get(SAME_PLACE.get(a[0], a[0]), (None, None))) for a in AIRPORTS]
    named = {a[0] for a in AIRPORTS}
    rows += [(c, None, None, None, *at[c]) for c in at if c not in named]
    return spark.createDataFrame(rows, "icao string, name string, city string, country string, latitude double, longitude double")


def in_box(rows: DataFrame, box: str) -> DataFrame:
    """Rows whose latitude and longitude lie in a box."""
    a, b, c, d = BOXES[box]
    return rows.where(rows["latitude"].between(a, b) & rows["longitude"].between(c, d))
