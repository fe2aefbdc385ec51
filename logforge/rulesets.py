"""The audit rule sets that ship with the package.

Each entry is one rule in load order.  A long rule set is not repeated here:
read it from its file with ``logforge.sources.rules.read_rules``.
"""

from __future__ import annotations


def _w(path: str, perm: str, key: str) -> dict:
    return {"watch": path, "perm": perm, "key": key}


def _a(key: str, calls: str = "", fields: str = "", where: str = "exit,always") -> dict:
    return {"where": where, "calls": calls, "fields": fields, "key": key}


def _both(key: str, calls: str, fields: str = "") -> list[dict]:
    """The same rule for both architectures."""
    return [_a(key, calls, f"arch={arch} {fields}") for arch in ("b64", "b32")]


_PERSON = "auid>=1000 auid!=4294967295"

# --- fixed values: rule set `universal` --------------------------------------
UNIVERSAL = [
    _w("/etc/passwd", "wa", "passwd_changes"),
    _w("/etc/shadow", "wa", "shadow_changes"),
    _w("/etc/group", "wa", "group_changes"),
    _w("/etc/gshadow", "wa", "gshadow_changes"),
    _w("/etc/security/opasswd", "wa", "opasswd_changes"),
    _w("/etc/sudoers", "wa", "sudoers_changes"),
    _w("/etc/sudoers.d/", "wa", "sudoers_d_changes"),
    _w("/etc/ssh/sshd_config", "wa", "sshd_config_changes"),
    _a("ssh_config_changes", fields="dir=/etc/ssh perm=wa"),
    _w("/sbin/insmod", "x", "kernel_modules"),
    _w("/sbin/rmmod", "x", "kernel_modules"),
    _w("/sbin/modprobe", "x", "kernel_modules"),
    *_both("kernel_modules", "init_module,finit_module"),
    *_both("file_deletion", "unlink,unlinkat,rename,renameat", _PERSON),
    _a("privilege_escalation", "setuid,setgid,setreuid,setregid", "arch=b64"),
    _a("privilege_escalation", "setuid,setgid,setreuid32,setregid32", "arch=b32"),
    *_both("command_execution", "execve"),
    *_both("network_connections", "socket,connect,accept,bind"),
    _w("/etc/shadow", "r", "T1003_credential_dumping"),
    _w("/etc/security/opasswd", "r", "T1003_credential_dumping"),
    _w("/etc/passwd", "r", "T1003_credential_dumping"),
    _w("/etc/gshadow", "r", "T1003_credential_dumping"),
    _w("/root/.bash_history", "wa", "T1070_bash_history"),
    _w("/home/", "wa", "T1070_bash_history"),
    _w("/var/log/faillog", "wa", "T1078_login_failures"),
    _w("/var/log/lastlog", "wa", "T1078_login_success"),
    _w("/var/log/tallylog", "wa", "T1078_login_failures"),
    *[
        _a("T1098_account_changes", fields=f"path={path} perm=x")
        for path in (
            "/usr/bin/passwd", "/usr/sbin/usermod", "/usr/sbin/adduser", "/usr/sbin/useradd",
            "/usr/sbin/groupadd", "/usr/sbin/groupmod", "/usr/sbin/addgroup",
        )
    ],
    _a("T1548_sudo_abuse", fields="path=/usr/bin/sudo perm=x"),
    _a("T1548_su_abuse", fields="path=/usr/bin/su perm=x"),
    _w("/etc/sudoers", "wa", "T1548_sudoers_modification"),
    _w("/etc/sudoers.d/", "wa", "T1548_sudoers_modification"),
]

# --- fixed values: rule set `universal_minimal` ------------------------------
UNIVERSAL_MINIMAL = [
    *_both("execve_rule", "execve"),
    *_both("connect_rule", "connect"),
    *_both("accept_rule", "accept"),
    *_both("bind_rule", "bind"),
]

# --- fixed values: rule set `host_minimal` -----------------------------------
HOST_MINIMAL = [
    _w("/etc/shadow", "wa", "T1003_credential_dumping"),
    _w("/etc/gshadow", "wa", "T1003_credential_dumping"),
    *_both("T1136_create_account", "useradd,groupadd", _PERSON),
    _w("/etc/sudoers", "wa", "T1098_account_manipulation"),
    _w("/etc/sudoers.d/", "wa", "T1098_account_manipulation"),
    *_both("T1548_privilege_escalation", "setuid,setgid", _PERSON),
    _w("/etc/audit/", "wa", "T1562_defense_evasion"),
    _w("/etc/rsyslog.conf", "wa", "T1562_defense_evasion"),
    *_both("T1059_root_commands", "execve", "uid=0"),
    _w("/etc/ssh/sshd_config", "wa", "T1021_remote_services"),
    _w("/root/.ssh/", "wa", "T1021_remote_services"),
    _w("/etc/crontab", "wa", "T1053_scheduled_task"),
    _w("/etc/cron.d/", "wa", "T1053_scheduled_task"),
    _w("/var/spool/cron/", "wa", "T1053_scheduled_task"),
    *_both("T1055_process_injection", "ptrace", "a0=0x10 " + _PERSON),
    *_both("T1215_kernel_modules", "init_module,delete_module", "auid!=-1"),
]

# --- fixed values: rule set `manual` -----------------------------------------
MANUAL = [
    _w("/etc/passwd", "wa", "identity_changes"),
    _w("/etc/shadow", "wa", "credential_access"),
    _w("/etc/group", "wa", "identity_changes"),
    _w("/etc/gshadow", "wa", "credential_access"),
    _w("/etc/sudoers", "wa", "privilege_escalation"),
    _w("/etc/sudoers.d/", "wa", "privilege_escalation"),
    _w("/etc/pam.d/", "wa", "authentication_config"),
    _w("/etc/security/", "wa", "security_config"),
    _w("/etc/login.defs", "wa", "login_config"),
    _w("/etc/ssh/sshd_config", "wa", "ssh_config"),
    _w("/etc/ssh/ssh_config", "wa", "ssh_config"),
    _w("/root/.ssh/", "wa", "ssh_keys"),
    _w("/home/*/.ssh/", "wa", "ssh_keys"),
    *_both("root_commands", "execve"),
    _w("/bin/su", "x", "privilege_escalation"),
    _w("/usr/bin/sudo", "x", "privilege_escalation"),
    _w("/usr/bin/pkexec", "x", "privilege_escalation"),
    *_both("network_config", "sethostname,setdomainname"),
    _w("/etc/hosts", "wa", "network_config"),
    _w("/etc/resolv.conf", "wa", "network_config"),
    _w("/etc/hostname", "wa", "network_config"),
    _w("/etc/network/interfaces", "wa", "network_config"),
    _w("/etc/netplan/", "wa", "network_config"),
    _w("/etc/NetworkManager/", "wa", "network_config"),
    _w("/sbin/shutdown", "x", "system_shutdown"),
    _w("/sbin/poweroff", "x", "system_shutdown"),
    _w("/sbin/reboot", "x", "system_shutdown"),
    _w("/sbin/halt", "x", "system_shutdown"),
    *_both("file_permissions", "chmod,fchmod,fchmodat", _PERSON),
    *_both("file_ownership", "chown,fchown,lchown,fchownat", _PERSON),
    _w("/usr/bin/wget", "x", "network_tools"),
    _w("/usr/bin/curl", "x", "network_tools"),
    _w("/bin/nc", "x", "network_tools"),
    _w("/usr/bin/ncat", "x", "network_tools"),
    _w("/usr/bin/netcat", "x", "network_tools"),
    _w("/usr/bin/ssh", "x", "remote_access"),
    _w("/usr/bin/scp", "x", "remote_access"),
    _w("/usr/bin/sftp", "x", "remote_access"),
    _w("/usr/bin/rsync", "x", "remote_access"),
    _w("/usr/bin/whoami", "x", "system_discovery"),
    _w("/usr/bin/id", "x", "system_discovery"),
    _w("/usr/bin/w", "x", "system_discovery"),
    _w("/usr/bin/who", "x", "system_discovery"),
    _w("/etc/cron.d/", "wa", "scheduled_tasks"),
    _w("/etc/cron.daily/", "wa", "scheduled_tasks"),
    _w("/etc/cron.hourly/", "wa", "scheduled_tasks"),
    _w("/etc/cron.monthly/", "wa", "scheduled_tasks"),
    _w("/etc/cron.weekly/", "wa", "scheduled_tasks"),
    _w("/var/spool/cron/", "wa", "scheduled_tasks"),
    _w("/etc/crontab", "wa", "scheduled_tasks"),
    _w("/etc/systemd/system/", "wa", "systemd_services"),
    _w("/lib/systemd/system/", "wa", "systemd_services"),
    _w("/usr/lib/systemd/system/", "wa", "systemd_services"),
    *_both("kernel_modules", "init_module,delete_module"),
    _w("/sbin/insmod", "x", "kernel_modules"),
    _w("/sbin/rmmod", "x", "kernel_modules"),
    _w("/sbin/modprobe", "x", "kernel_modules"),
    _w("/var/log/auth.log", "wa", "log_modification"),
    _w("/var/log/syslog", "wa", "log_modification"),
    _w("/var/log/audit/", "wa", "audit_log_modification"),
    _w("/etc/audit/", "wa", "audit_config"),
    _w("/sbin/auditctl", "x", "audit_tools"),
    _w("/sbin/auditd", "x", "audit_tools"),
]

# --- fixed values: suppression rules that come before all others -------------
FILTERS = [
    *[
        _a(None, fields=f"msgtype={kind}", where="exclude,always")
        for kind in ("AVC", "CWD", "EOE")
    ],
    _a(None, fields="subj_type=crond_t", where="user,never"),
    _a(None, fields="subj_type=crond_t", where="exit,never"),
    _a(None, "adjtimex", "arch=b64 auid=unset uid=chrony subj_type=chronyd_t", "exit,never"),
    _a(None, fields="msgtype=CRYPTO_KEY_USER", where="exclude,always"),
    *[
        _a(
            None,
            "fork",
            f"arch={arch} success=0 path=/usr/lib/vmware-tools subj_type=initrc_t exit=-2",
            "exit,never",
        )
        for arch in ("b32", "b64")
    ],
    *[
        _a(key, fields=f"arch={arch} dir={path}", where="exit,never")
        for path, key in (("/dev/shm", "sharedmemaccess"), ("/var/lock/lvm", "locklvm"))
        for arch in ("b32", "b64")
    ],
]

RULESETS = {
    "universal": UNIVERSAL,
    "universal_minimal": UNIVERSAL_MINIMAL,
    "host_minimal": HOST_MINIMAL,
    "manual": MANUAL,
    "filters": FILTERS,
}
_OPERATORS = ("!=", ">=", "<=", "=")


def _field(text: str) -> tuple[str, str, str]:
    op = next(o for o in _OPERATORS if o in text)
    name, value = text.split(op, 1)
    return name, op, value


def rule_rows(name: str) -> list[tuple]:
    """Rows (ruleset, idx, kind, list, action, path, is_dir, perm, syscalls, fields, key)."""
    rows = []
    for idx, r in enumerate(RULESETS[name]):
        if "watch" in r:
            path = r["watch"]
            rows.append(
                (name, idx, "watch", "exit", "always", path.rstrip("/"), path.endswith("/"),
                 r["perm"], [], [], r["key"])
            )
        else:
            to_list, action = r["where"].split(",")
            calls = r["calls"].split(",") if r["calls"] else []
            fields = [_field(f) for f in r["fields"].split()]
            rows.append(
                (name, idx, "syscall", to_list, action, None, None, None, calls, fields, r["key"])
            )
    return rows
