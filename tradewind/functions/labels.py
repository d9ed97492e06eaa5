"""Labels that source codes and names are translated to.

Every table below has to hold exactly these values, spelled exactly like this,
for results to come out right.
"""

# Country name -> label. Names not listed have no label.
COUNTRY_LABELS = {
    "France": "França",
    "Canada": "Canadá",
    "United States": "Estados Unidos",
    "Germany": "Alemanha",
    "United Kingdom": "Reino Unido",
    "Australia": "Austrália",
}

# Sales territory -> label. Names not listed have no label.
TERRITORY_LABELS = {
    "Australia": "Austrália",
    "Canada": "Canadá",
    "Germany": "Alemanha",
    "France": "França",
    "United Kingdom": "Reino Unido",
    "Southeast": "Sudeste",
    "Northwest": "Noroeste",
    "Southwest": "Sudoeste",
    "Central": "Central",
    "Northeast": "Nordeste",
}

# Job title -> label. Titles not listed have no label.
JOB_TITLE_LABELS = {
    "North American Sales Manager": "Gerente de Vendas Norte-Americano",
    "Sales Representative": "Representante de vendas",
    "European Sales Manager": "Gerente de Vendas Europeu",
    "Pacific Sales Manager": "Gerente de Vendas do Pacífico",
}

# Person type code -> label.
PERSON_TYPE_LABELS = {
    "SC": "Contato da loja",
    "IN": "Cliente individual",
    "SP": "Vendedor",
    "EM": "Funcionário",
    "VC": "Contato do fornecedor",
    "GC": "Contato geral",
}
UNKNOWN_PERSON_TYPE = "Desconhecido"

# Product category -> label. Names not listed have no label.
CATEGORY_LABELS = {
    "Accessories": "Acessórios",
    "Bikes": "Bicicletas",
    "Clothing": "Roupas",
    "Components": "Componentes",
}

# Product subcategory -> label.
SUBCATEGORY_LABELS = {
    "Bib-Shorts": "Shorts",
    "Bike Racks": "Bicicletários",
    "Bike Stands": "Suportes para bicicletas",
    "Bottom Brackets": "Colchetes Inferiores",
    "Bottles and Cages": "Garrafas e gaiolas",
    "Brakes": "Freios",
    "Caps": "Cápsulas",
    "Chains": "Correntes",
    "Cleaners": "Limpadores",
    "Cranksets": "Pedaleiras",
    "Derailleurs": "Desviadores",
    "Fenders": "Pára-lamas",
    "Forks": "Garfos",
    "Gloves": "Luvas",
    "Headsets": "Fones de ouvido",
    "Helmets": "Capacetes",
    "Hydration Packs": "Pacotes de hidratação",
    "Jerseys": "Camisas",
    "Lights": "Luzes",
    "Locks": "Fechaduras",
    "Mountain Bikes": "Bicicletas de montanha",
    "Mountain Frames": "Quadros de montanha",
    "Panniers": "Cestos",
    "Pedals": "Pedais",
    "Pumps": "Bombas",
    "Road Bikes": "Bicicletas de estrada",
    "Road Frames": "Quadros de estrada",
    "Saddles": "Selas",
    "Shorts": "Shorts",
    "Socks": "Meias",
    "Tights": "Meia-calça",
    "Tires and Tubes": "Pneus e Câmaras de Ar",
    "Touring Bikes": "Bicicletas de turismo",
    "Touring Frames": "Quadros de turismo",
    "Vests": "Coletes",
    "Wheels": "Rodas",
}
OTHER_SUBCATEGORY = "Outro"

# Order status code -> label. Codes not listed have no label.
STATUS_LABELS = {
    1: "Em processo",
    2: "Aprovado",
    3: "Pedido em espera",
    4: "Rejeitado",
    5: "Enviado",
    6: "Cancelado",
}
# Orders in these states do not count as sales.
CLOSED_STATUSES = ("Cancelado", "Rejeitado")

# Joined reason names -> label. Other strings stay as they are. The
# names are joined in alphabetical order, so the four entries that begin with
# "Price |" or "Television Advertisement |" never occur; they are kept because the
# table is part of the agreed result.
REASON_SEPARATOR = " | "
REASON_LABELS = {
    "Manufacturer | Quality": "Fabricante | Qualidade",
    "On Promotion": "Em promoção",
    "Review": "Análise",
    "Price": "Preço",
    "Price | On Promotion": "Preço | Em promoção",
    "Manufacturer": "Fabricante",
    "Price | On Promotion | Other": "Preço | Em promoção | Outro",
    "Price | Other": "Preço | Outro",
    "Television Advertisement": "Anúncio de televisão",
    "Television Advertisement | Other": "Anúncio de televisão | Outro",
    "On Promotion | Other": "Em promoção | Outro",
    "Manufacturer | Other": "Fabricante | Outro",
}

# Flag column -> (text that sets it, chart label), in report order.
REASON_FLAGS = {
    "price": ("Price", "Preço"),
    "manufacturer": ("Manufacturer", "Fabricante"),
    "quality": ("Quality", "Qualidade"),
    "promotion": ("On Promotion", "Promoção"),
    "review": ("Review", "Análise"),
    "other": ("Other", "Outro"),
    "television": ("Television Advertisement", "TV"),
}

# Sales channels.
ONLINE_CHANNEL = "Online"
STORE_CHANNEL = "Loja Física"

# Weekday names by Spark's dayofweek (1 = Sunday).
WEEKDAY_NAMES = {
    1: "Domingo",
    2: "Segunda-feira",
    3: "Terça-feira",
    4: "Quarta-feira",
    5: "Quinta-feira",
    6: "Sexta-feira",
    7: "Sábado",
}

# Month names.
MONTH_NAMES = {
    1: "Janeiro",
    2: "Fevereiro",
    3: "Março",
    4: "Abril",
    5: "Maio",
    6: "Junho",
    7: "Julho",
    8: "Agosto",
    9: "Setembro",
    10: "Outubro",
    11: "Novembro",
    12: "Dezembro",
}

# How surrogate keys join their parts, and what stands for NULL.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"
