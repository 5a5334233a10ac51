"""Fixed values of the SQL side, stated here again: nothing in the SQL comes from the Spark side's code."""

from __future__ import annotations

# Column names of the levels and targets.
LEVELS = [
    "proporcao_aluno_nivel_0", "proporcao_aluno_nivel_1", "proporcao_aluno_nivel_2", "proporcao_aluno_nivel_3", "proporcao_aluno_nivel_4",
    "proporcao_aluno_nivel_5", "proporcao_aluno_nivel_6", "proporcao_aluno_nivel_7", "proporcao_aluno_nivel_8",
]
TARGET_YEARS = [2024, 2025, 2026, 2027, 2028, 2029, 2030]
TARGETS = [
    "meta_alfabetizacao_2024", "meta_alfabetizacao_2025", "meta_alfabetizacao_2026", "meta_alfabetizacao_2027",
    "meta_alfabetizacao_2028", "meta_alfabetizacao_2029", "meta_alfabetizacao_2030",
]

# Cut-offs and labels of the ranking.
CLASS_CUTS = [(90.0, "Alto"), (75.0, "Médio")]
CLASS_DEFAULT = "Requer atenção"

# The 27 state codes.
VALID_STATES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]

# The code dictionary of the test views.
DICTIONARY_ROWS = [
    ("uf", "serie", "1", "1º ano EF"),
    ("uf", "serie", "2", "2º ano EF"),
    ("uf", "serie", "3", "3º ano EF"),
    ("uf", "serie", "4", "4º ano EF"),
    ("uf", "rede", "1", "Federal"),
    ("uf", "rede", "2", "Estadual"),
    ("uf", "rede", "6", "Municipal"),
    ("uf", "rede", "8", "Privada"),
    ("uf", "rede", "13", "Pública"),
    ("municipio", "serie", "65", "2º ano EF"),
    ("municipio", "serie", "78", "3º ano EF"),
    ("municipio", "rede", "70", "Municipal"),
    ("municipio", "rede", "79", "Estadual"),
    ("alunos", "serie", "65", "2º ano EF"),
    ("alunos", "serie", "78", "3º ano EF"),
    ("alunos", "serie", "82", "4º ano EF"),
    ("alunos", "rede", "70", "Municipal"),
    ("alunos", "rede", "79", "Estadual"),
    ("alunos", "presenca", "0", "Ausente"),
    ("alunos", "presenca", "1", "Presente"),
    ("alunos", "preenchimento_caderno", "0", "Preenchido"),
    ("alunos", "preenchimento_caderno", "1", "Parcial"),
    ("alunos", "alfabetizado", "0", "Não alfabetizado"),
    ("alunos", "alfabetizado", "1", "Alfabetizado"),
]

# Event kinds and networks of the test views.
EVENT_KINDS = {
    "view": "medicao_desempenho", "click": "medicao_desempenho", "purchase": "atualizacao_meta",
    "error": "revisao_indicador", "signup": "revisao_indicador",
}
NETWORKS = ["Municipal", "Estadual", "Privada", "Federal"]
