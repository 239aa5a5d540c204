"""Types of the event fields, and the shape every event is read into.

A column outside the event record stays as the source has it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Event fields by type, in record order.
LONG_FIELDS = [
    "eventtime", "u_id", "u_createdate", "u_enabledate", "u_disabledate", "u_deletedate",
    "u_updatedate", "u_sunrisedate", "u_sunsetdate", "u_vacationstart", "u_vacationend",
    "u_hiredate", "u_rehiredate", "u_recenthiredate", "u_terminationdate", "u_lastdayworked",
    "u_contractstartdate", "u_contractenddate", "u_lastperformancereviewdate",
    "u_transferreddate", "u_datasourceid", "u_lastsynctime", "rg_id", "rg_ownerid",
    "rg_resourcetypeid", "rg_clusterid", "rg_customerid", "rg_parentid", "filecreatetime",
    "filemodificationtime", "tpi_date", "tpi_version", "accountcreateddate",
    "accountdisableddate", "tenantid", "oldfilecreatetime",
]
DOUBLE_FIELDS = [
    "u_riskscore", "u_customfield21", "u_customfield22", "u_customfield23", "rg_riskscore",
    "transactionnumber1", "transactionnumber2", "transactionnumber3", "transactionnumber4",
    "transactionnumber5", "customnumber1", "customnumber2", "customnumber3", "eventlatitude",
    "eventlongitude", "sourcehostnamelatitude", "sourcehostnamelongitude",
    "destinationhostnamelatitude", "destinationhostnamelongitude", "resourcehostnamelatitude",
    "resourcehostnamelongitude", "devicehostnamelatitude", "devicehostnamelongitude",
    "tpi_criticality",
]
INT_FIELDS = [
    "year", "week", "month", "dayofyear", "dayofweek", "dayofmonth", "hour", "minute",
    "u_status", "rg_amountroundupvalue", "rg_syslogport", "rg_parentstatus",
    "destinationprocessid", "destinationport", "sourceprocessid", "sourceport",
    "deviceprocessid", "filesize", "bytesin", "bytesout", "oldfilesize", "translatedport",
    "baseeventcount",
]
BOOLEAN_FIELDS = [
    "u_encrypted", "u_masked", "u_skipencryption", "rg_syslogenabled",
    "rg_retainedaccessentitlements", "accountwhitelisted", "accountblacklisted",
    "accountencrypted",
]
HOSTS = ("sourcehostname", "destinationhostname", "resourcehostname", "devicehostname")
TEXT_FIELDS = [
    "eventid", "accountname", "rawevent", "u_employeeid", "u_firstname", "u_middlename",
    "u_lastname", "u_department", "u_division", "u_location", "u_manageremployeeid", "u_workemail",
    "u_workphone", "u_title", "u_employeetype", "u_uniquecode", "u_promoted", "u_usergroup",
    "u_street", "u_city", "u_province", "u_zipcode", "u_userstate", "u_region", "u_country",
    "u_approveremployeeid", "u_delegateemployeeid", "u_technicalapproverid", "u_extension", "u_fax",
    "u_mobile", "u_pager", "u_jobcode", "u_comments", "u_createdby", "u_costcentername",
    "u_costcentercode", "u_criticality", "u_domintlin", "u_nameprefix", "u_namesuffix",
    "u_preferredname", "u_secondaryphone", "u_statusdescription", "u_networkid", "u_workpager",
    "u_workextensionnumber", "u_workfax", "u_employeestatuscode", "u_locationcode",
    "u_locationname", "u_mailcode", "u_employeetypedescription", "u_regtempin",
    "u_fulltimeparttimein", "u_managerfirstname", "u_managerlastname", "u_managermiddlename",
    "u_orgunitnumber", "u_companycode", "u_companynumber", "u_hierarchy",
    "u_lastperformancereviewresult", "u_standardhours", "u_shiftcode", "u_shiftname", "u_lanid",
    "u_userid", "u_timezoneoffset", "u_encryptedfields", "u_maskedfields", "u_mergeuniquecode",
    "rg_name", "rg_type", "rg_vendor", "rg_functionality", "rg_criticality", "rg_deviceid",
    "rg_timezoneoffset", "rg_aggregatelevel", "rg_ipaddress", "rg_category", "resourcename",
    "resourcetype", "ipaddress", "others", "eventcount", "siemid", "flowsiemid", "alertid",
    "applicationprotocol", "destinationhostname", "destinationmacaddress", "destinationntdomain",
    "destinationuserprivileges", "destinationprocessname", "destinationaddress",
    "destinationuserid", "destinationusername", "destinationdnsdomain", "sourcehostname",
    "sourcemacaddress", "sourcentdomain", "sourceprocessname", "sourceuserprivileges",
    "sourceaddress", "deviceinboundinterface", "deviceoutboundinterface", "deviceprocessname",
    "deviceseverity", "deviceaction", "deviceeventcategory", "deviceaddress", "devicehostname",
    "filename", "filepath", "filetype", "oldfilename", "oldfilepath", "oldfiletype", "message",
    "eventoutcome", "transportprotocol", "requesturl", "zone", "classification",
    "requestclientapplication", "requestcontext", "requestmethod", "translatedipaddress",
    "sessionid", "categoryobject", "categorybehavior", "categorizedtime", "baseeventid",
    "emailsubject", "emailsender", "emailsenderdomain", "emailrecipient", "emailrecipientdomain",
    "emailrecipienttype", "resourcecomments", "resourcehierarchy", "resourcehierarchyname",
    "resourcestatus", "resourcehostname", "postalcode", "tpi_addr", "tpi_domain", "tpi_type",
    "tpi_src", "tpi_text", "tpi_category", "tpi_reason", "tpi_description", "tpi_filename",
    "tpi_action", "tpi_malware", "tpi_risk", "tpi_recommendation", "tpi_resolution",
    "tpi_indicators", "accountcriticality", "accounttype", "accountowner", "accountstatus",
    "categoryoutcome", "categoryseverity", "tenantname", "tenanttz", "oldfilepermission",
    "oldfilehash", "deviceexternalid",
    # Numbered fields, and the place of an address.
    *[f"u_customfield{i}" for i in range(1, 31) if f"u_customfield{i}" not in DOUBLE_FIELDS],
    *[f"transactionstring{i}" for i in range(1, 7)],
    *[f"customstring{i}" for i in range(1, 4)],
    *[f"resourcecustomfield{i}" for i in range(1, 9)],
    *[f"{whose}{part}" for whose in ("event", *HOSTS) for part in ("country", "region", "city")],
    *[f"{host}postalcode" for host in HOSTS],
]
# A bad text here rejects the row, and a score must arrive as a number.
STRICT_LONG_FIELDS = ["tenantid"]
NUMBER_ONLY_FIELDS = ["rg_riskscore"]

FIELD_TYPES: dict[str, T.DataType] = {
    **{name: T.LongType() for name in LONG_FIELDS},
    **{name: T.DoubleType() for name in DOUBLE_FIELDS},
    **{name: T.IntegerType() for name in INT_FIELDS},
    **{name: T.BooleanType() for name in BOOLEAN_FIELDS},
    **{name: T.StringType() for name in TEXT_FIELDS},
}

def event_schema(fields: list[str]) -> T.StructType:
    """The schema of event files with the given fields: typed by name, text where not named above."""
    return T.StructType([T.StructField(name, FIELD_TYPES.get(name, T.StringType())) for name in fields])


# Column that says which resource group an event belongs to.
GROUP = "rg_id"
