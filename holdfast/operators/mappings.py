"""Source columns and the properties they become, per feed."""

from __future__ import annotations

BOND_METRICS = {
    "BUY_YIELD": "buyYield", "CORP_PRETAX_YIELD": "corporatePretaxYield", "CORP_AFTER_TAX_YIELD": "corporateAfterTaxYield",
    "AFTER_TAX_YIELD": "afterTaxYield", "PREF_TAX_YIELD": "preferentialTaxYield", "AVG_ANNUAL_TAX_YIELD": "averageAnnualTaxYield",
    "DEPO_EQUIV_YIELD_154": "depositEquivalentYield154", "BUYABLE_QUANTITY": "buyableQuantity", "REMAINING_DAYS": "remainingDays",
    "DUR": "durationRaw", "COV": "convexityRaw", "NDY_DUR": "nextDayDurationRaw", "NDY_COV": "nextDayConvexityRaw",
    "EVAL_PRICE": "evaluationPrice", "APPLIED_YIELD": "appliedYield", "DIRTY": "dirtyPrice", "NDY_EVAL_PRICE": "nextDayEvaluationPrice",
    "NDY_APPLIED_YIELD": "nextDayAppliedYield", "NDY_DIRTY": "nextDayDirtyPrice",
}
MARKET_METRICS = {
    "du_bpr": "basePrice", "du_opr": "openPrice", "du_hpr": "highPrice", "du_lpr": "lowPrice", "du_clpr": "closePrice",
    "du_diff_rt": "priceChangeRate", "du_val_1d": "tradingValue1d", "du_vol_1d": "tradingVolume1d", "du_vol_avg_5d": "averageVolume5d",
    "du_vol_avg_1m": "averageVolume1m", "ru_mkt_price": "realtimeMarketPrice", "ru_mkt_volume": "realtimeMarketVolume",
    "nru_mkt_inav": "realtimeIndicativeNav", "nru_mkt_diff_rt": "realtimeMarketDifferenceRate",
}
FUND_METRICS = {
    "du_last_aum": "assetsUnderManagement", "du_last_nav": "netAssetValue", "du_nav_yday": "previousNav", "du_nav_rnf_amt": "navChangeAmount",
    "du_er_1d": "return1d", "du_er_5d": "return5d", "du_er_1m": "return1m", "du_er_3m": "return3m", "du_er_6m": "return6m",
    "du_er_1y": "return1y", "du_er_ytd": "returnYtd", "pd_net_tamt": "netAssetTotal", "pd_nav_pshr": "navPerShare",
    "pd_net_ast_pshr": "netAssetsPerShare", "pd_net_prft_pshr": "netProfitPerShare", "pd_net_rt_ast_pshr": "netReturnAssetsPerShare",
}
PUBLIC_FUND_METRICS = {
    "fd_nast_suma": "netAssetTotal", "fd_wk1_ern_r": "return1w", "fd_mm1_ern_r": "return1m", "fd_mm3_ern_r": "return3m",
    "fd_mm6_ern_r": "return6m", "fd_mm18_ern_r": "return18m", "fd_yr1_ern_r": "return1y", "fd_yr2_ern_r": "return2y",
    "fd_yr3_ern_r": "return3y", "fd_yr5_ern_r": "return5y",
}
BOND_PROPERTIES = {
    "PD_NO": "sourceProductNumber", "PD_NM": "name", "PD_ABRV_NM": "shortName", "PD_ENG_NM": "englishName", "PD_ABRV_ENG_NM": "shortEnglishName",
    "PD_CTRY_CD": "countryCode", "CURR_CD": "currency", "PD_EXG_MKT": "exchangeMarket", "PD_PBCM": "issuerDisplayName",
}
BOND_NUMBERS = {"ISU_BAL_AMT": "issueOutstandingAmount", "SRFC_IRT": "couponRate"}
BOND_DATES = {"ISU_DT": "issueDate", "MAT_DT": "maturityDate"}
BOND_CLASSIFICATIONS = {"bond-main-category": ["STD_PD_MCLS_NM"], "bond-subcategory": ["STD_PD_SCLS_NM"], "bond-kind": ["BD_KND"], "credit-grade": ["CRD_GRD", "PD_EVCO_CRD_GRD"], "risk-code": ["PD_RISK_GCD"]}
EXCHANGE_PROPERTIES = {"pd_itm_no": "sourceItemNumber", "pd_nm": "name", "pd_abrv_nm": "shortName", "cu_strtegy": "strategy", "cu_base_index": "baseIndexName", "cu_index_repl_mthd": "indexReplicationMethod"}
EXCHANGE_NUMBERS = {"cu_lev_fector": "leverageFactor", "cu_charge_rt": "feeRate", "cu_charge_etc_rt": "otherFeeRate"}
EXCHANGE_FLAGS = {"cu_index_tracking_yn": "indexTracking", "cu_inverse_short_yn": "inverseOrShort"}
EXCHANGE_CLASSIFICATIONS = {"product-group": ["pd_grp_no"], "investment-asset-type": ["wu_inv_ast_type"], "investment-region": ["wu_inv_rgn"], "sector": ["pd_sect_cd"], "risk": ["pd_risk_cd"]}
PUBLIC_PROPERTIES = {
    "itm_abrv_nm": "shortName", "itm_eng_nm": "englishName", "curr_cd": "currency", "fd_estb_ctry_cd": "countryCode",
    "prvo_fd_desc": "privateFundDescription", "prvo_pbff_desc": "publicPrivateDescription",
}
PUBLIC_FLAGS = {"exchdg_yn": "currencyHedged", "ofsfd_yn": "overseasFund"}
PUBLIC_CLASSIFICATIONS = {
    "product-attribute": ["prfd_attr_cd"], "kofia-fund-class": ["kofia_fd_ccd"], "fund-set-product-code": ["fd_set_pcd"],
    "investment-region": ["fd_ivst_rgn_desc"], "fund-type": ["or_attr_desc"], "investor-kind": ["pers_corp_desc"], "risk-grade": ["zrin_fd_ivst_risk_gcd"],
}
NAME_HEURISTIC = ["상장지수", "ETF"]
LISTED_BOND_MARKET = "장내"
BOND_MARKET = ("KRX_BOND", "Korean exchange-traded bond market")
UNKNOWN_VENUE = ("KRX_UNSPECIFIED", "Korea Exchange (venue not supplied)")
EXCHANGE_UNIT_CLASSES = ["TradableFundUnit", "ListedSecurity"]
PUBLIC_UNIT_CLASSES = {True: ["TradableFundUnit", "ListedSecurity", "PublicFundUnit"], False: ["NonTradableFundUnit", "PublicFundUnit"]}
