"""Fixed values of the policy settings: the names a policy may use."""

# Device functionalities.
FUNCTIONALITIES = [
    "Identity Access Management",
    "Application / Enterprise / SaaS",
    "Web Proxy",
    "Email / Email Security",
    "Next Generation Firewall",
    "Network Security",
    "Authentication / VPN",
    "Data Loss Prevention / Endpoint DLP",
    "Firewall",
    "Content Management System",
    "Cloud Services / Applications",
    "Data Loss Prevention / Network DLP",
    "Antivirus / Malware / EDR",
    "Unix / Linux / AIX",
    "Access / Privileged User",
    "Microsoft Windows",
    "Endpoint Management Systems",
    "Audit",
    "DNS / DHCP",
    "Access Management",
    "Authentication / SSO / Single Sign-On",
    "Security Analytics Platform",
]

# Policy categories by id.
CATEGORIES = {
    1: "INSIDER THREAT",
    2: "CONFIGURATION ERROR",
    3: "TRAFFIC ANOMALY",
    4: "IDENTITY ISSUE",
    5: "FRAUD",
    6: "SECURITY POLICY VIOLATION",
    7: "ACCOUNT MISUSE",
    8: "DATA EXFILTRATION",
    9: "EXPLOIT",
    10: "MALWARE",
    11: "ALERT",
}

# Criticalities and violation entities, the first of each the default.
CRITICALITIES = ["Low", "Medium", "High"]
ENTITIES = ["Activityaccount", "Users", "Activityip", "Resources"]

# Settings of a newly made policy.
NEW_POLICY = {
    "resourcegroupid": -1,
    "resourcetypeid": -1,
    "type": "HDFS",
    "analyticstype": "CUSTOM",
    "targetworkflow": "PolicyOutlierWorkflow",
    "weight": 1,
    "createdby": "admin",
    "updatedby": "admin",
    "dashboarddisplay": True,
    "enabled": True,
}
FIRST_SIGNATURE_ID = 1000000
THREAT_LEVEL = "Medium"

# Threat indicators offered for a policy (other names are allowed too).
THREATS = [
    "Activity by Terminated User",
    "Possible Brute Force Attack",
    "Audit Log Tampering",
    "Interactive Logon by Service Accounts",
    "Account Created & Deleted",
    "Possible exiting behavior",
    "Data egress attempts",
    "Circumvention of controls",
    "Possible data hoarding",
    "File sharing with personal accounts",
    "Spike In Failed SSHD Logs",
    "Data egress via network uploads",
    "File sharing with external non business domains",
    "Unauthorized file sharing to external non business domains",
    "Undocumented accounts performing activity",
    "Activity towards a rare hostname never connected before",
    "Account connecting to multiple destination address",
    "Jumpbox server violation",
    "Possible DoS Attack",
    "Abnormal high number of login failure - Remote Address",
    "Password Reset Anomaly",
    "Detection of Domain Trust Additions",
    "Possible Account Enumeration",
    "Possible Privilege Enumeration",
    "Replay attack detection",
    "User accessing password hash",
    "Rare process creation",
    "Abnormal attempts to reset domain admin password",
    "Suspicious FTP - Use of insecure file transfer methods",
    "Detect use of XTERM,Xwindows by user",
    "Detect presence and attempted use of the telnet utility",
    "User emailing files to external email addresses",
    "Data egress via upload",
    "Landspeed anomaly",
    "Abnormal number of password retrieval compared to past behavior",
    "Checked Out Password With Reason - Forgot Password",
    "Abnormal number of files downloaded",
    "Only member in the peer group to access a file share site",
    "Hosts with disabled AV",
    "Hosts with outdated AV",
    "Unauthorized VPN usage",
    "Non compliant hosts",
    "Privilege misuse - Password checkout by Cyberark admin",
    "Suspicious Process For Host Heuristics Anomaly",
    "User deleting audit trails",
    "Backdoor Account - Creation",
    "Rare Basic Service Operation",
    "High number of hosts accessed for authentication failures or lockout events",
    "High number of accounts used on a workstation for authentication failures or lockout events",
    "High number of hosts accessed for successful authentication events or run as events",
    "High number of accounts used on a workstation for successful authentications or run as events",
    "High number of accounts from the same ipaddress for successful authentications or run as events",
    "High number of accounts from the same ipaddress for authentication failures or lockout events",
    "Rare file hash detected across the organization - endpoint monitoring",
    "Rare process and path combination - endpoint monitoring",
    "Rare parent process and child process combination - endpoint monitoring",
    "Rare dll used by a process - endpoint monitoring",
    "Rare function used by dll",
    "Rare dll process and path combination",
    "Detection of new admin account authentication",
    "Abnormal number of failed admin authentications compared to past behavior",
    "Abnormal number of failed authentications compared to past behavior",
    "Abnormal number of password changes compared to past behavior",
    "Abnormal number of authorization failures compared to past behavior",
    "Suspicious admin account change detected",
    "Possible audit log tampering detected",
    "Abnormal number of audit file deletions",
    "Suspicious web request",
    "Suspicious application detected",
    "Possible C2 Communication",
    "Traffic to known malicious websites",
    "Traffic to randomly generated domains",
    "Usage of credential dumping tools",
    "Possible backdoor account",
    "Possible bruteforce",
    "Possible account sharing or password misuse",
    "Possible circumvention of controls",
    "Possible escalation of privileges",
    "Spike in remote interactive logon attempts",
    "Rare local account created",
    "Member added to built-in admin groups by uncorelated accounts",
    "Abnormal number of objects viewed",
    "Volume of object copied and or moved",
    "DATA EGRESS VIA EMAIL",
    "Data aggregation over network",
    "Suspicious user management event detected",
    "Suspicious group management event detected",
    "Authentication From Rare Geolocation",
    "Landspeed violation- Use of account from multiple geolocations",
    "Abnormal number of file deletions compared to past behavior",
    "Possible phishing attempt",
    "Possible sabotage",
    "Data aggregation from file shares",
    "Possible Data Snooping",
    "Covert channel traffic",
    "DNS traffic anomaly",
    "Network Scanning and Enumeration",
    "Suspicious file type detected",
    "DNS amplification",
    "DHCP traffic anomaly",
    "Data egress via removable media",
    "Abnormal number of file downloads compared to past behavior",
    "Data egress using service account",
    "Self privilege escalation",
    "Abnormal number of signon failures compared to past behavior",
    "User creation and deletion in a short period of time",
    "Possible privilege misuse",
    "Suspicious AD authentication",
    "Exfiltration via Cloud Collaboration",
    "Suspicious network share access",
    "Possible unauthorized access",
    "Suspicious process execution",
    "Activity by undocumented accounts",
    "Password hash access",
    "Suspicious VPN authentication",
    "Activity from malicious address",
    "AD Enumeration",
    "Vulnerable Endpoint",
    "Infected Endpoint",
    "Lateral Movement",
    "Blocked web requests",
    "Suspicious data egress",
    "Suspicious cloud application access",
    "Data egress via cloud collaboration",
    "Suspicious network traffic",
    "Suspicious Access Pattern",
    "Suspicious Authentication",
]
