"""Death certificates."""

from __future__ import annotations

from sanitaria.functions.filenames import death_period
from sanitaria.systems.base import System, Window, parse_fields, register

# The canonical columns in schema order, as Spark types.  Spark has
# no unsigned types, so those columns take the next wider type and a range guard.
FIELDS = """
uf string, source_file string, origem tinyint,
tipobito tinyint, dtobito date, horaobito string, natural smallint, codmunnatu int, dtnasc date,
idade string, idade_valor smallint, idade_unidade string, sexo string, racacor string,
estciv tinyint, esc tinyint, esc2010 tinyint, seriescfal tinyint, ocup int,
codmunres int, lococor tinyint, codestab int, estabdescr string, codmunocor int,
idademae tinyint, escmae tinyint, escmae2010 tinyint, seriescmae tinyint, ocupmae int,
qtdfilvivo tinyint, qtdfilmort tinyint, gravidez tinyint,
causabas array<string>, linhaa array<string>, linhab array<string>, linhac array<string>,
linhad array<string>, linhaii array<string>,
circobito tinyint, acidtrab boolean, fonte tinyint, tppos boolean, dtinvestig date,
causabas_o string, dtcadastro date, atestado array<string>, atestante tinyint, fonteinv tinyint,
dtrecebim date,
tpmorteoco tinyint, semagestac tinyint, gestacao tinyint, parto tinyint, obitoparto tinyint,
peso smallint, obitograv tinyint, obitopuerp tinyint, assistmed tinyint, exame tinyint,
cirurgia tinyint, necropsia tinyint,
dtatestado date,
numerolote bigint, versaosist string, versaoscb string, contador bigint, difdata int,
nudiasobco int, nudiasobin int, dtcadinf date, morteparto tinyint, dtrecoriga date,
causamat array<string>, escmaeagr1 tinyint, escfalagr1 tinyint, dtcadinv date, tpobitocor tinyint,
dtconinv date, fontes string, tpresginfo tinyint, tpnivelinv string, nudiasinf smallint,
dtconcaso date, fontesinf string, stcodifica boolean, codificado boolean, cb_pre string,
altcausa boolean, comunsvoim int,
stdoepidem boolean, stdonova boolean
"""

# Largest value of the columns that are unsigned in the record layout.
UNSIGNED_MAX = {
    "idade_valor": 255,
    "numerolote": 4294967295,
    "contador": 4294967295,
    "difdata": 65535,
    "nudiasobco": 65535,
    "nudiasobin": 65535,
}

# Codes read as true and as false; anything else is NULL.
BOOLEANS = {
    "acidtrab": (("1",), ("2",)),
    "tppos": (("1", "S"), ("2", "N")),
    "stcodifica": (("S",), ("N",)),
    "codificado": (("S",), ("N",)),
    "altcausa": (("1",), ("2",)),
    "stdoepidem": (("1",), ("0",)),
    "stdonova": (("1",), ("0",)),
}

# Code to label.
SEX = {"M": "M", "1": "M", "F": "F", "2": "F", "I": "I", "0": "I", "9": "I"}
RACE = {"1": "Branca", "2": "Preta", "3": "Amarela", "4": "Parda", "5": "Indigena"}
SCHOOLING = {
    "1": "Nenhuma",
    "2": "de 1 a 3 anos",
    "3": "de 4 a 7 anos",
    "4": "de 8 a 11 anos",
    "5": "12 anos e mais",
    "9": "Ignorado",
}
SCHOOLING_2010 = {
    "0": "Sem escolaridade",
    "1": "Fundamental I (1ª a 4ª série)",
    "2": "Fundamental II (5ª a 8ª série)",
    "3": "Médio (antigo 2º Grau)",
    "4": "Superior incompleto",
    "5": "Superior completo",
    "9": "Ignorado",
}
LABELS = {
    "tipobito": {"1": "Fetal", "2": "Não Fetal"},
    "estciv": {
        "1": "Solteiro",
        "2": "Casado",
        "3": "Viúvo",
        "4": "Separado judicialmente/divorciado",
        "5": "União estável",
        "9": "Ignorado",
    },
    "esc2010": SCHOOLING_2010,
    "lococor": {
        "1": "hospital",
        "2": "outros estabelecimentos de saúde",
        "3": "domicílio",
        "4": "via pública",
        "5": "outros",
        "6": "aldeia indígena",
        "9": "ignorado",
    },
    "escmae": SCHOOLING,
    "escmae2010": SCHOOLING_2010,
    "circobito": {"1": "acidente", "2": "suicídio", "3": "homicídio", "4": "outros", "9": "ignorado"},
    "fonte": {"1": "ocorrência policial", "2": "hospital", "3": "família", "4": "outra", "9": "ignorado"},
    "esc": SCHOOLING,
    "atestante": {"1": "Assistente", "2": "Substituto", "3": "IML", "4": "SVO", "5": "Outro"},
    "gestacao": {
        "1": "Menos de 22 semanas",
        "2": "22 a 27 semanas",
        "3": "28 a 31 semanas",
        "4": "32 a 36 semanas",
        "5": "37 a 41 semanas",
        "6": "42 e + semanas",
    },
    "origem": {
        "1": "Oracle",
        "2": "Banco estadual diponibilizado via FTP",
        "3": "Banco SEADE",
        "9": "Ignorado",
    },
}

# Source folders and the years they cover.
WINDOWS = (
    Window("/dissemin/publicos/SIM/CID9/DORES/", 1979, 1995),
    Window("/dissemin/publicos/SIM/CID10/DORES/", 1996, 9999),
)

DEATH = register(
    System(
        name="sim",
        title="Death certificates",
        prefix="DO",
        fields=parse_fields(FIELDS),
        event_date="dtobito",
        period=death_period,
        residence="codmunres",
        yearly=True,
        windows=WINDOWS,
        unsigned_max=UNSIGNED_MAX,
        time_columns=frozenset({"horaobito"}),
        booleans=BOOLEANS,
        sex=SEX,
        sex_default="I",
        race=RACE,
        labels=LABELS,
        encoded_age="idade",
        order_by="dtobito",
        mean_file_mb=5,
    )
)
