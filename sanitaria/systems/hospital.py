"""Hospital admissions."""

from __future__ import annotations

from sanitaria.functions.filenames import hospital_period
from sanitaria.systems.base import System, Window, parse_fields, register

# The canonical columns in schema order, as Spark types.
FIELDS = """
uf string, source_file string,
uf_zi int, ano_cmpt smallint, mes_cmpt tinyint, espec smallint, cgc_hosp bigint, n_aih string,
ident tinyint, cep string, munic_res int,
nasc date, sexo string,
uti_mes_in tinyint, uti_mes_an tinyint, uti_mes_al tinyint, uti_mes_to tinyint, marca_uti tinyint,
uti_int_in tinyint, uti_int_an tinyint, uti_int_al tinyint, uti_int_to tinyint,
proc_rea string, val_sh float, val_sp float, val_sadt float, val_rn float, val_ortp float,
val_sangue float, val_sadtsr float, val_transp float, val_obsang float, val_ped1ac float,
val_tot float, val_uti float, us_tot float,
dt_inter date, dt_saida date,
diag_princ string, diag_secun string,
cobranca tinyint, natureza tinyint, gestao tinyint, gestão tinyint, munic_mov int,
cod_idade tinyint, idade tinyint, dias_perm smallint,
morte boolean,
cod_arq tinyint, cont tinyint, nacional smallint,
num_proc smallint, car_int tinyint, tot_pt_sp smallint,
cpf_aut string, homonimo tinyint, num_filhos tinyint, instru tinyint, cid_notif string,
contracep1 tinyint, contracep2 tinyint, gestrisco boolean,
val_sh_fed float, val_sp_fed float, val_sh_ges float, val_sp_ges float, val_uci float,
diar_acom smallint, qt_diarias smallint,
cbor smallint, cnaer smallint, etnia smallint, raca_cor string,
cid_asso string, cid_morte string,
diagsec1 string, diagsec2 string, diagsec3 string, diagsec4 string, diagsec5 string,
diagsec6 string, diagsec7 string, diagsec8 string, diagsec9 string,
tpdisec1 tinyint, tpdisec2 tinyint, tpdisec3 tinyint, tpdisec4 tinyint, tpdisec5 tinyint,
tpdisec6 tinyint, tpdisec7 tinyint, tpdisec8 tinyint, tpdisec9 tinyint,
insc_pn bigint, seq_aih5 smallint, vincprev tinyint, gestor_cod smallint, gestor_cpf bigint,
gestor_dt date, cnes int, cgc_mant bigint, complex tinyint, faec_tp int, financ tinyint,
gestor_tp tinyint, regct smallint, remessa string, sequencia smallint, aud_just string,
nat_jur smallint, sis_just string, marca_uci smallint
"""

# Columns that hold one diagnosis code each.
CODE_COLUMNS = """
diag_princ diag_secun cid_asso cid_morte cid_notif
diagsec1 diagsec2 diagsec3 diagsec4 diagsec5 diagsec6 diagsec7 diagsec8 diagsec9
"""

# Code to label.
SEX = {"0": "I", "1": "M", "3": "F"}
RACE = {"01": "Branca", "02": "Preta", "03": "Parda", "04": "Amarela", "05": "Indigena"}

# Source folders and the years they cover.
WINDOWS = (
    Window("/dissemin/publicos/SIHSUS/199201_200712/Dados/", 1992, 2007),
    Window("/dissemin/publicos/SIHSUS/200801_/Dados/", 2008, 9999),
)

HOSPITAL = register(
    System(
        name="sihsus",
        title="Hospital admissions",
        prefix="RD",
        fields=parse_fields(FIELDS),
        event_date="dt_inter",
        period=hospital_period,
        residence="munic_res",
        windows=WINDOWS,
        code_columns=frozenset(CODE_COLUMNS.split()),
        sex=SEX,
        race=RACE,
        mean_file_mb=20,
    )
)
