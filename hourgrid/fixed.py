"""Fixed values of the domain: codes, names, factors and lookup tables."""

# Fixed values ---------------------------------------------------------------

HOURS_PER_YEAR = 8760
CHUNK_HOURS = 750
WATT_PER_MEGAWATT = 1_000_000
MV_LIMIT_KV = 150
CONSTANT_WEIGHT = 13.3

PROFILE_START = "2018-12-31 23:00:00"
PEAK_MARGIN = 1.1
IDLE_VALUE = 0.0001

ELECTRICITY_CLASS = "EConnection"
GAS_CLASS = "GConnection"
METHANE_CARRIERS = ["RTLH_NODO", "RTLG_NODO", "HTLH", "HTLG", "RTLH_ODO", "RTLG_ODO", "GM", "CH4"]
HYDROGEN_CARRIERS = ["H2_new"]
CO2_CARRIERS = ["CO2_F", "CO2_B", "CO2_P"]
METHANE_ASSETS = ["LNGImport_MV", "CH4Import_Wijngaarden"]
HYDROGEN_ASSETS = ["ImportH2_MV", "ExportH2_Per", "ExportH2_new_Hinterland"]

# order matters: the first code found in a name is the one replaced
GAS_CODES = ["RTLH_ODO", "RTLG_ODO", "RTLH_NODO", "RTLG_NODO", "HTLH", "HTLG", "GM"]
GAS_CODE_NAME = "CH4"

IGNORED_SITE = "Rijnmond_Per"

# carrier -> (export site, import site), and carrier -> balance node
SLACK_SITES = {
    "methane": ("CH4Export_Per", "CH4Import_Wijngaarden"),
    "hydrogen": ("ExportH2_Per", "ImportH2_MV"),
}
BALANCE_NODES = {"methane": "BAL_M", "hydrogen": "BAL_H"}

HYDROGEN_NODES = [
    "W1_001", "W1_002", "W1_003", "W1_004",
    "HW_001", "HW_002", "HW_003", "HW_004", "HW_005", "HW_006", "HW_007",
    "BAL_H",
]

# inlet carrier -> plant class
PLANT_CLASS_OF_CARRIER = {
    "RTLH_ODO": "Power Plant Gas Large",
    "GM": "Power Plant Gas Large",
    "RTLG_ODO": "Power Plant Gas Large",
    "RTLH_NODO": "Power Plant Gas Large",
    "RTLG_NODO": "Power Plant Gas Large",
    "HTLH": "Power Plant Gas Large",
    "HTLG": "Power Plant Gas Large",
    "H2_new": "Power Plant Gas Small",
    "H2_local": "Power Plant Gas Small",
    "H2_Hvision": "Power Plant Gas Small",
    "C": "Power Plant Coal",
    "BM": "Power Plant Biomass",
    "W": "Power Plant Other",
}

# market curve key -> plant class
PLANT_CLASS_OF_KEY = {
    "energy_chp_ultra_supercritical_coal.output (MW)": "Power Plant Coal",
    "energy_chp_ultra_supercritical_cofiring_coal.output (MW)": "Power Plant Coal",
    "energy_chp_ultra_supercritical_lignite.output (MW)": "Power Plant Coal",
    "energy_power_combined_cycle_ccs_coal.output (MW)": "Power Plant Coal",
    "energy_power_combined_cycle_coal.output (MW)": "Power Plant Coal",
    "energy_power_supercritical_coal.output (MW)": "Power Plant Coal",
    "energy_power_ultra_supercritical_ccs_coal.output (MW)": "Power Plant Coal",
    "energy_power_ultra_supercritical_coal.output (MW)": "Power Plant Coal",
    "energy_power_ultra_supercritical_cofiring_coal.output (MW)": "Power Plant Coal",
    "industry_chp_ultra_supercritical_coal.output (MW)": "Power Plant Coal",
    "energy_power_combined_cycle_ccs_network_gas.output (MW)": "Power Plant Gas Large",
    "energy_power_combined_cycle_hydrogen.output (MW)": "Power Plant Gas Large",
    "energy_power_combined_cycle_network_gas.output (MW)": "Power Plant Gas Large",
    "industry_chp_engine_gas_power_fuelmix.output (MW)": "Power Plant Gas Large",
    "industry_chp_turbine_gas_power_fuelmix.output (MW)": "Power Plant Gas Large",
    "energy_chp_local_engine_biogas.output (MW)": "Power Plant Gas Small",
    "energy_chp_local_engine_network_gas.output (MW)": "Power Plant Gas Small",
    "energy_power_engine_network_gas.output (MW)": "Power Plant Gas Small",
    "energy_power_turbine_hydrogen.output (MW)": "Power Plant Gas Small",
    "energy_power_turbine_network_gas.output (MW)": "Power Plant Gas Small",
    "energy_power_ultra_supercritical_network_gas.output (MW)": "Power Plant Gas Small",
    "industry_chp_combined_cycle_gas_power_fuelmix.output (MW)": "Power Plant Gas Small",
    "energy_power_nuclear_gen2_uranium_oxide.output (MW)": "Power Plant Nuclear",
    "energy_power_nuclear_gen3_uranium_oxide.output (MW)": "Power Plant Nuclear",
    "energy_chp_local_wood_pellets.output (MW)": "Power Plant Biomass",
    "energy_chp_supercritical_waste_mix.output (MW)": "Power Plant Other",
    "energy_power_engine_diesel.output (MW)": "Power Plant Other",
    "energy_power_geothermal.output (MW)": "Power Plant Other",
    "energy_power_hydro_mountain.output (MW)": "Power Plant Other",
    "energy_power_hydro_river.output (MW)": "Power Plant Other",
    "energy_power_supercritical_waste_mix.output (MW)": "Power Plant Other",
    "energy_power_ultra_supercritical_crude_oil.output (MW)": "Power Plant Other",
    "energy_power_ultra_supercritical_lignite.output (MW)": "Power Plant Other",
    "energy_power_ultra_supercritical_oxyfuel_ccs_lignite.output (MW)": "Power Plant Other",
    "industry_chp_wood_pellets.output (MW)": "Power Plant Other",
}
