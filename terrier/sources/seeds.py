"""Reference list of the French départements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEPARTEMENTS_SCHEMA = (
    "CODE_DEPARTEMENT string, NOM_DEPARTEMENT string, LATITUDE double, LONGITUDE double"
)

# Code, name, latitude and longitude of the centroid.
DEPARTEMENTS = """
01,Ain,46.2044,5.2257
02,Aisne,49.5634,3.6204
03,Allier,46.5671,3.3327
04,Alpes-de-Haute-Provence,44.0919,6.2356
05,Hautes-Alpes,44.5594,6.0789
06,Alpes-Maritimes,43.7102,7.2620
07,Ardèche,44.7361,4.5967
08,Ardennes,49.7686,4.7214
09,Ariège,42.9671,1.6052
10,Aube,48.2973,4.0744
11,Aude,43.2130,2.3491
12,Aveyron,44.3517,2.5754
13,Bouches-du-Rhône,43.2965,5.3698
14,Calvados,49.1829,-0.3707
15,Cantal,44.9309,2.4436
16,Charente,45.6500,0.1500
17,Charente-Maritime,45.7500,-0.6333
18,Cher,47.0833,2.4000
19,Corrèze,45.2686,1.7735
21,Côte-d'Or,47.3220,5.0415
22,Côtes-d'Armor,48.5141,-2.7610
23,Creuse,46.1667,1.8722
24,Dordogne,45.1849,0.7217
25,Doubs,47.2378,6.0241
26,Drôme,44.9333,4.8917
27,Eure,49.0244,1.1508
28,Eure-et-Loir,48.4439,1.4892
29,Finistère,48.3833,-4.4833
2A,Corse-du-Sud,41.9267,8.7369
2B,Haute-Corse,42.6997,9.4500
30,Gard,43.8367,4.3601
31,Haute-Garonne,43.6047,1.4442
32,Gers,43.6461,0.5859
33,Gironde,44.8378,-0.5792
34,Hérault,43.6108,3.8767
35,Ille-et-Vilaine,48.1147,-1.6794
36,Indre,46.8114,1.6906
37,Indre-et-Loire,47.3941,0.6848
38,Isère,45.1885,5.7245
39,Jura,46.6740,5.5565
40,Landes,43.8927,-0.4992
41,Loir-et-Cher,47.5861,1.3359
42,Loire,45.4397,4.3872
43,Haute-Loire,45.0428,3.8845
44,Loire-Atlantique,47.2184,-1.5536
45,Loiret,47.9029,1.9093
46,Lot,44.4475,1.4403
47,Lot-et-Garonne,44.2033,0.6167
48,Lozère,44.5181,3.4986
49,Maine-et-Loire,47.4784,-0.5632
50,Manche,48.8836,-1.5253
51,Marne,49.0431,4.0347
52,Haute-Marne,48.1117,5.1391
53,Mayenne,48.3024,-0.6160
54,Meurthe-et-Moselle,48.6921,6.1844
55,Meuse,49.1603,5.3869
56,Morbihan,47.6558,-2.7600
57,Moselle,49.1193,6.1757
58,Nièvre,47.0000,3.1590
59,Nord,50.6292,3.0573
60,Oise,49.4178,2.8262
61,Orne,48.4320,-0.0910
62,Pas-de-Calais,50.4262,2.8319
63,Puy-de-Dôme,45.7772,3.0870
64,Pyrénées-Atlantiques,43.2951,-0.3708
65,Hautes-Pyrénées,43.2327,0.0782
66,Pyrénées-Orientales,42.6988,2.8959
67,Bas-Rhin,48.5734,7.7521
68,Haut-Rhin,47.7508,7.3359
69,Rhône,45.7640,4.8357
70,Haute-Saône,47.6189,6.1519
71,Saône-et-Loire,46.7833,4.8500
72,Sarthe,47.9959,0.1996
73,Savoie,45.5646,5.9178
74,Haute-Savoie,45.8992,6.1294
75,Paris,48.8566,2.3522
76,Seine-Maritime,49.4432,1.0993
77,Seine-et-Marne,48.5383,2.6578
78,Yvelines,48.8014,2.1301
79,Deux-Sèvres,46.3230,-0.4603
80,Somme,49.8941,2.2958
81,Tarn,43.8967,2.1500
82,Tarn-et-Garonne,44.0176,1.3557
83,Var,43.1242,6.1286
84,Vaucluse,44.0570,5.0479
85,Vendée,46.6705,-1.4263
86,Vienne,46.5802,0.3404
87,Haute-Vienne,45.8336,1.2611
88,Vosges,48.1744,6.4512
89,Yonne,47.7986,3.5673
90,Territoire de Belfort,47.6400,6.8628
91,Essonne,48.6319,2.4378
92,Hauts-de-Seine,48.8925,2.2078
93,Seine-Saint-Denis,48.9356,2.3539
94,Val-de-Marne,48.7904,2.4701
95,Val-d'Oise,49.0333,2.0667
971,Guadeloupe,16.2650,-61.5510
972,Martinique,14.6415,-61.0242
973,Guyane,4.9372,-52.3260
974,La Réunion,-21.1151,55.5364
976,Mayotte,-12.8275,45.1662
"""


def departement_rows() -> list[tuple[str, str, float, float]]:
    lines = (line.split(",") for line in DEPARTEMENTS.strip().splitlines())
    return [(code, name, float(lat), float(lon)) for code, name, lat, lon in lines]


def ref_departements(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The built-in list (101 rows, hence always broadcast), or a CSV file of the same shape."""
    if path:
        return spark.read.schema(DEPARTEMENTS_SCHEMA).csv(path, header=True)
    return F.broadcast(spark.createDataFrame(departement_rows(), DEPARTEMENTS_SCHEMA))
