"""A small installation: CSV files of all sources, and a function that writes them."""

from __future__ import annotations

from pathlib import Path

from degraus.spec import SOURCES

YEARS = range(2024, 2031)
GOALS = ",".join(f"meta_alfabetizacao_{y}" for y in YEARS)

FILES = {
    # A trailing blank is trimmed, a lower-case state raised.
    "indicador_municipio": [
        "ano,id_municipio,serie,rede,taxa_alfabetizacao,media_portugues",
        "2023,4300001 ,2,5,60.0,740.1",
        "2023,4300001,2,3,55.0,735.0",
        "2024,4300001,2,5,52.5,731.0",
        "2024,4300001,2,3,64.36,731.0",
        "2024,3500002,2,3,91.0,760.0",
        "2024,3500003,2,2,48.0,720.0",
        "2023,3500002,2,3,80.0,750.0",
    ],
    "indicador_uf": [
        "ano,sigla_uf,serie,rede,taxa_alfabetizacao,media_portugues",
        "2023,RS,2,5,63.43,748.0",
        "2024,rs,2,5,44.67,735.0",
        "2023,SP,2,5,52.0,745.0",
        "2024,SP,2,5,58.5,747.0",
        "2024,SP,2,3,57.0,747.0",
    ],
    # Columns in another order than the table definition, and one that is not in it.
    "meta_brasil": [
        f"rede,ano,taxa_alfabetizacao,{GOALS},percentual_participacao,observacao",
        "Pública,2025,66,60,64,67,71,74,77,80,88,revisada",
        "Pública,2024,59.2,59.9,63.77,67.47,70.97,74.23,77.24,80,87.37,",
        "Pública,2023,55.9,59.9,63.77,67.47,70.97,74.23,77.24,80,85,NA",
    ],
    "meta_uf": [
        f"ano,sigla_uf,rede,taxa_alfabetizacao,{GOALS},percentual_participacao",
        "2023,RS,Pública,63.4,66.1,68,70,72,75,78,80,90",
        "2024,RS,Pública,44.7,66.2,68.5,71,73,75,78,80,91",
        "2024,SP,Pública,58.5,57.9,60,64,68,72,76,80,92",
        "2024,RR,Pública,,,,,,,,,",
    ],
    "meta_municipio": [
        f"ano,id_municipio,rede,taxa_alfabetizacao,{GOALS},nivel_alfabetizacao,percentual_participacao",
        "2023,4300001,Municipal,55,63.0,65,67,70,73,76,80,2,90",
        "2024,4300001,Municipal,64.36,64.0,66,68,71,74,77,80,2,90",
        "2024,3500002,Municipal,91,92.5,93,94,95,96,97,98,4,95",
    ],
    "alunos": [
        "ano,id_municipio,id_escola,id_aluno,caderno,serie,rede,presenca,preenchimento_caderno,alfabetizado,proficiencia,peso_aluno",
        "2023,4300001,01,0001,1,2,3,1,1,1,750.5,1.0",
        "2023,4300001,01,0002,1,2,3,1,1,0,700.0,1.0",
        "2024,4300001,01,0001,1,2,3,1,1,1,760.0,1.0",
        "2024,4300001,01,0002,1,2,3,0,0,0,,",
        "2024,3500002,02,0003,2,2,2,1,1,1,745.0,1.0",
    ],
    "diretorio_municipio": [
        "id_municipio,nome,sigla_uf,nome_uf,nome_regiao,amazonia_legal,capital_uf,ddd,centroide",
        '4300001, Bagé ,rs,Rio Grande do Sul,Sul,0,0,53,"POINT(1, 2)"',
        "3500002,Águas da Prata – SP,SP,São Paulo,Sudeste,0,0,19,",
        "3500003,Itu,SP,São Paulo,Sudeste,0,0,11,",
    ],
    "diretorio_uf": ["id_uf,sigla,nome,regiao", "43,RS,Rio Grande do Sul,Sul", "35,SP,São Paulo,Sudeste"],
    "idhm_municipio": [
        "ANO,Codmun7,Município Nome Atlas,IDHM,IDHM_E,IDHM_L,IDHM_R",
        '2000,4300001,BAGE,"0,650","0,5","0,7","0,6"',
        '2010,4300001,BAGE,"0,740","0,65","0,8","0,75"',
        "2010,3500002,AGUAS,0.76,0.7,0.8,0.77",
    ],
}

# Files stored in Windows-1252, with characters outside Latin-1 (the dash) among them.
WINDOWS = {"diretorio_municipio", "meta_uf"}


def write_sources(folder: Path, changes: dict[str, list[str] | None] | None = None) -> str:
    """Write all source files; ``changes`` replaces one, or leaves it out when None."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in {**FILES, **(changes or {})}.items():
        if lines is not None:
            encoding = "cp1252" if name in WINDOWS else "utf-8"
            (folder / SOURCES[name].file).write_bytes(("\n".join(lines) + "\n").encode(encoding))
    return str(folder)
